"""Reach writes and shuffles what it finds, not the graph; with few or many nodes in a round it finds the same."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import lineage


def grid(spark):
    """A chain a0 > a1 > ... > a9 with a side step, and 20,000 edges that it does not touch; every edge twice."""
    chain = [(f"a{i}", f"a{i + 1}") for i in range(9)] + [("a0", "a3"), ("a9", "a2")]
    rest = spark.range(20_000).select(F.format_string("x%d", F.col("id") % 700).alias("src"), F.format_string("y%d", "id").alias("dst"))
    links = spark.createDataFrame(chain, "src string, dst string").unionByName(rest)
    return links.unionByName(links).distinct()


WANTED = {"a1": 1, "a2": 2, "a3": 1, "a4": 2, "a5": 3, "a6": 4, "a7": 5, "a8": 6, "a9": 7}


def test_only_found_nodes_are_written(spark, monkeypatch):
    written, cut = [], lineage.cut_lineage

    def counted(df):
        rows = cut(df)
        written.append(rows.count())
        return rows

    monkeypatch.setattr(lineage, "cut_lineage", counted)
    assert {r.node: r.steps for r in lineage.reachable(grid(spark), "a0").collect()} == WANTED
    assert sum(written) == len(WANTED)


@pytest.mark.parametrize("few", [0, 1, 500_000])
def test_rounds_of_many_nodes_find_the_same(spark, monkeypatch, few):
    monkeypatch.setattr(lineage, "FEW", few)
    assert {r.node: r.steps for r in lineage.reachable(grid(spark), "a0").collect()} == WANTED
    assert {r.node: r.steps for r in lineage.reachable(grid(spark), "y5", upstream=True).collect()} == {"x5": 1}
