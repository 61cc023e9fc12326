"""Digests of partitions do not depend on order or files, but on every value and repeat."""

from __future__ import annotations

from shelfmark.operators import digests


def outcome(spark, before, after):
    make = lambda rows: spark.createDataFrame(rows, "p int, a int, b string")
    return {r.p: (r.rows_before, r.rows_after, r.outcome) for r in digests.compared(make(before), make(after).repartition(3), ["p"]).collect()}


def test_digests(spark):
    before = [(1, 1, "x"), (1, 2, None), (2, 5, "y"), (3, 1, "z"), (4, 1, "a"), (4, 1, "a"), (5, None, "5")]
    after = [(1, 2, None), (1, 1, "x"), (2, 5, "Y"), (4, 1, "a"), (4, 1, "b"), (5, 5, None), (6, 0, "")]
    assert outcome(spark, before, after) == {
        1: (2, 2, "same"), 2: (1, 1, "changed"), 3: (1, None, "dropped"), 4: (2, 2, "changed"), 5: (1, 1, "changed"), 6: (None, 1, "added")}
    assert outcome(spark, [(1, 1, "a")], [(1, 1, "a"), (1, 1, "a")]) == {1: (1, 2, "changed")}
    assert outcome(spark, [(1, 1, "a")], [(1, 1, "a")]) == {1: (1, 1, "same")}
