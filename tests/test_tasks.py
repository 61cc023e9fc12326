"""Steps on lines are dealt to as many tasks as the lines' files need."""

from __future__ import annotations

import re

import shelfmark.operators.lines as lines_of
import shelfmark.plans.customers as customers
from shelfmark.registry import customers as registry

FOLDER = "/root/testdata/sf0.001"


def test_premium_share_takes_as_many_tasks_as_the_files_need(spark, monkeypatch):
    wanted = sorted(map(tuple, registry.premium_share(spark, FOLDER).collect()))
    for module in (lines_of, customers):
        monkeypatch.setattr(module, "TASK_BYTES", 1 << 10)
    found = registry.premium_share(spark, FOLDER)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Lines, lines and orders at their join, customers' products, products and catalog at theirs, customers' brands, customers.
    dealt = [int(n) for n in re.findall(r"RepartitionByExpression \[.*\], (\d+)", plan)]
    assert len(dealt) == 8 and min(dealt) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, found.collect())) == wanted
