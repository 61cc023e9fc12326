"""Input columns whose names are those of results or of inner columns, in either case of letters."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import credentials, licenses, ngram_join, quality_rules

CLASHING = ["_key", "_spans", "_row", "_parts", "_id", "_digest", "_measures", "SPANS", "KEPT", "LICENSE", "_in0"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame([(1, "password = abcdefghijklmnop1234"), (2, "same words in two rows here"), (3, "same words in two rows here"),
                                (None, None), (4, None), (5, "")], "doc_id long, text string")
    return df.select("*", *[F.lit(name).alias(name) for name in CLASHING])


def test_stages_keep_all_columns(odd):
    kept = ngram_join.without_near_copies(odd)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "5", "None"]
    masked = credentials.masked(odd)
    assert masked.columns == odd.columns and masked.count() == 6
    assert masked.filter("doc_id = 1").first()["text"] == "[MASKED]" and all(r["_key"] == "_key" for r in masked.collect())


def test_results_replace_columns_in_either_case(odd, spark):
    for result, name in ((credentials.scan(odd), "spans"), (quality_rules.judge(odd), "kept"), (licenses.scan(odd, licenses.known_digests(spark)), "license")):
        names = [c.lower() for c in result.columns]
        assert len(names) == len(set(names)) and result.select(name).count() == 6


def test_whole_texts_of_long_licences(spark):
    folder = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "CC0-1.0": "CC0-1.0", "GPL-2.0": "GPL-2", "GPL-3.0": "GPL-3", "LGPL-3.0": "LGPL-3", "MPL-2.0": "MPL-2.0"}
    if not all((folder / f).is_file() for f in files.values()):
        pytest.skip("the texts are not on this machine")
    texts = [(name, (folder / f).read_text()) for name, f in files.items()]
    df = spark.createDataFrame(texts + [("none", texts[0][1] + " and more")], "name string, text string")
    got = {r["name"]: r["license"] for r in licenses.scan(df, licenses.known_digests(spark), keep=["name"]).collect()}
    assert got == {**{name: name for name in files}, "none": None}
