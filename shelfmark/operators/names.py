"""Names as numbers in the order of the names, so that aggregates can compare them at a fixed width."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.ranking import with_row_number
from shelfmark.session import cut_lineage


def numbered(values: DataFrame, name: str) -> DataFrame:
    """``_name`` and ``_number`` (from 1, in order) of the distinct names of a column; no row for null."""
    distinct = values.filter(F.col(name).isNotNull()).select(F.col(name).alias("_name")).distinct()
    return cut_lineage(with_row_number(distinct, [F.col("_name").asc()], "_number"))


def with_number(df: DataFrame, names: DataFrame, name: str, number: str) -> DataFrame:
    """Adds the number of a name column; null stays null."""
    return df.join(names.select(F.col("_name").alias("_n"), F.col("_number").alias(number)), F.col(name) == F.col("_n"), "left").drop("_n")


def with_name(df: DataFrame, names: DataFrame, number: str, name: str) -> DataFrame:
    """Adds the name of a number column; null stays null."""
    return df.join(names.select(F.col("_number").alias("_n"), F.col("_name").alias(name)), F.col(number) == F.col("_n"), "left").drop("_n")
