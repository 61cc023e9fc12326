"""The touches of the attribution mart are made once, whatever reads them."""

from __future__ import annotations

from shelfmark.plans import attribution
from shelfmark.registry import marketing

FOLDER = "/root/testdata/sf0.001"


def test_attribution_reads_the_given_tables_once(spark, monkeypatch):
    read = []
    for name in ("journeys", "journey_arrays"):
        step = getattr(attribution, name)
        monkeypatch.setattr(attribution, name, lambda touches, step=step: read.extend(touches.inputFiles()) or step(touches))
    assert marketing.gold_attribution(spark, FOLDER).count() > 0
    assert read and not [file for file in read if FOLDER in file]
