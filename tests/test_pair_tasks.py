"""Pairs and rules are dealt to as many tasks as the baskets' files need, not to the cluster's number alone."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from shelfmark.operators import pairing
from shelfmark.plans import baskets
from shelfmark.session import cut_lineage


def test_pairs_and_rules_take_more_tasks_as_baskets_grow(spark, monkeypatch):
    rng = random.Random(5)
    rows = sorted({(order, rng.randrange(30)) for order in range(400) for _ in range(rng.randrange(1, 6))})
    held = cut_lineage(spark.createDataFrame(rows, "transaction_id long, item long").withColumn("total_amount", F.lit(3).cast("decimal(12,2)")))
    monkeypatch.setattr(pairing, "TASK_BYTES", 256)
    monkeypatch.setattr(baskets, "PAIR_BYTES", 256)
    plan = baskets.association_rules(held, spark.range(400))._jdf.queryExecution().optimizedPlan().toString()
    dealt = [line for line in plan.splitlines() if "RepartitionByExpression [" in line]
    # Both sides of the pairs, the pairs, and both sides of two joins.
    assert len(dealt) == 7 and all(int(line.rsplit(", ", 1)[1]) > 6 for line in dealt)
    orders = {}
    for order, item in rows:
        orders.setdefault(order, []).append(item)
    want = Counter((a, b) for items in orders.values() for a in items for b in items if a < b)
    assert {(r["item_a"], r["item_b"]): r["transactions_with_both"] for r in baskets.pair_counts(held).collect()} == want
