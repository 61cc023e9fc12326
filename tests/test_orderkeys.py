"""Keys of fixed width compare as pairs and can be taken apart."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from shelfmark.functions import orderkeys
from shelfmark.operators.names import numbered, with_name, with_number


def test_keys_order_as_pairs(spark):
    rng = random.Random(3)
    edges = [-(2**61), -1, 0, 1, 2**61 - 1]
    pairs = [(a, b) for a in edges for b in (-(2**63), -1, 0, 1, 2**63 - 1)] + [(rng.randrange(-2**60, 2**60), rng.randrange(-2**62, 2**62)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a long, b long").withColumn("k", orderkeys.packed(F.col("a"), F.col("b")))
    rows = df.select("a", "b", "k", orderkeys.major_of(F.col("k")).alias("x"), orderkeys.minor_of(F.col("k")).alias("y")).collect()
    assert all((r.a, r.b) == (r.x, r.y) for r in rows)
    assert [(r.a, r.b) for r in sorted(rows, key=lambda r: r.k)] == sorted(pairs)


def test_null_keys(spark):
    row = spark.range(1).select(orderkeys.packed(F.lit(None).cast("long"), F.lit(1)).alias("k")).first()
    assert row.k is None


def test_minimum_of_keys_is_a_hash_aggregate(spark):
    plan = spark.range(9).groupBy(F.col("id") % 2).agg(F.min(orderkeys.packed(F.col("id"), F.col("id"))))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_names_and_numbers(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("é",)], "n string")
    names = numbered(df, "n")
    assert sorted(tuple(r) for r in names.collect()) == [("a", 1), ("b", 2), ("é", 3)]
    back = with_name(with_number(df, names, "n", "i"), names, "i", "m").collect()
    assert len(back) == 5 and all(r.n == r.m for r in back)
