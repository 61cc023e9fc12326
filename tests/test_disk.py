"""A cut leaves its rows on disk, and nothing of the shuffles behind them."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from shelfmark.plans import products
from shelfmark.registry import merchandise
from shelfmark.session import SHUFFLES_REMOVED, cut_lineage

FOLDER = "/root/testdata/sf0.001"


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_over(spark, known: set[str]) -> set[str]:
    """Removal is asked for at the end of a write and done shortly after."""
    for _ in range(50):
        if not (found := shuffle_files(spark) - known):
            break
        time.sleep(0.2)
    return found


def test_shuffles_of_a_cut_are_removed_with_its_end(spark):
    known, before = shuffle_files(spark), spark.conf.get(SHUFFLES_REMOVED)
    rows = cut_lineage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n")))
    assert not left_over(spark, known)
    assert spark.conf.get(SHUFFLES_REMOVED) == before
    assert rows.agg(F.sum("n")).first()[0] == 10_000


def test_product_mart_holds_no_shuffle_once_it_is_planned(spark, monkeypatch):
    """Every part of the mart is written by itself, and the mart joins what is written."""
    cuts, cut = [], products.cut_lineage
    monkeypatch.setattr(products, "cut_lineage", lambda df: cuts.append(df.columns) or cut(df))
    known = shuffle_files(spark)
    merchandise.gold_product_performance(spark, FOLDER)
    assert not left_over(spark, known)
    for column in ("top_return_reason", "stockout_days", "price_elasticity_coefficient", "top_cross_sell_products"):
        assert any("product_id" in columns and column in columns for columns in cuts)
