"""Data-quality checks; every check is one aggregate, never one job per column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import numbers
from shelfmark.functions.problems import first_cause


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def null_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per table and key column: rows, NULL keys, and the share of rows whose keys are all there."""
    reports = []
    for name, (df, keys) in tables.items():
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        counted = df.agg(
            F.count(F.lit(1)).alias("total_records"), F.count_if(any_null).alias("_bad"),
            *[F.count_if(F.col(k).isNull()).alias(k) for k in keys],
        )
        pairs = F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).alias("null_keys")) for k in keys])
        reports.append(
            counted.select(
                F.lit(name).alias("table_name"), "total_records",
                numbers.percent(F.col("total_records") - F.col("_bad"), F.col("total_records")).alias("valid_percentage"),
                F.explode(pairs).alias("_p"),
            ).select("table_name", "_p.key_column", "_p.null_keys", "total_records", "valid_percentage")
        )
    return stacked(reports)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return stacked(
        [df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    )


def nonempty(spark: SparkSession, tables: dict[str, DataFrame | Callable[[], DataFrame]]) -> DataFrame:
    """OK, EMPTY or ERROR per table, with the first cause of an error.

    A table may be given as a function that reads it, so that one that is not there is an
    ERROR as well. Each table is counted on its own: a broken one does not hide the others.
    """
    found = []
    for name, table in tables.items():
        try:
            rows = (table() if callable(table) else table).count()
            found.append((name, rows, "OK" if rows else "EMPTY", None))
        except (PySparkException, Py4JJavaError) as problem:
            found.append((name, None, "ERROR", first_cause(problem)))
    return spark.createDataFrame(found, "table_name string, row_count bigint, status string, message string")


def require_nonempty(spark: SparkSession, tables: dict[str, DataFrame | Callable[[], DataFrame]]) -> None:
    """The gate: stops the load, naming every table that has no rows or cannot be read."""
    bad = [f"{r['table_name']} ({r['status']})" for r in nonempty(spark, tables).collect() if r["status"] != "OK"]
    if bad:
        raise ValueError(f"tables without rows: {', '.join(sorted(bad))}")


def reconciliation(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows before and after a transform."""
    reports = []
    for name, (before, after) in pairs.items():
        sides = before.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("bronze")).unionByName(
            after.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit("silver"))
        )
        reports.append(
            sides.agg(
                F.max(F.when(F.col("side") == "bronze", F.col("n"))).alias("bronze_rows"),
                F.max(F.when(F.col("side") == "silver", F.col("n"))).alias("silver_rows"),
            ).select(F.lit(name).alias("table_name"), "bronze_rows", "silver_rows",
                     (F.col("bronze_rows") - F.col("silver_rows")).alias("lost_rows"))
        )
    return stacked(reports)


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value, most frequent first."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.orderBy(F.col("row_count").desc(), *columns)


def orphans(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines whose product has no current catalog row."""
    current = products.filter("is_current").select("product_id")
    return items.join(current, "product_id", "left_anti").agg(
        F.count(F.lit(1)).alias("orphan_lines"),
        F.count_distinct("product_id").alias("orphan_products"),
        F.coalesce(numbers.money(F.sum("line_total")), F.lit(0).cast("decimal(18,2)")).alias("orphan_revenue"),
    )
