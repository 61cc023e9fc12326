"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: every node's neighbours (all of them, or the smaller ones) are tied to the smallest of them and the node."""
    turned = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges.unionByName(turned)
    if not large:
        around = around.filter("v < u")
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = around.join(least, "u")
    if large:
        tied = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return tied.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge (u, v) and the smallest node that it reaches.

    Sums and minima only, nothing is gathered per node, and the tables stay in the
    shared folder between steps. The number of steps grows with the logarithm of the
    longest path; the loop ends when a step changes nothing.
    """
    now = cut_lineage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen["n"] == 0 or mark == (seen["n"], seen["s"]):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = (seen["n"], seen["s"])
        now = cut_lineage(_star(_star(now, True), False))
