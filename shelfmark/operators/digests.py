"""Order-free digests of partitions: what a write has changed, and what it has left alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_digests(df: DataFrame, by: list[str]) -> DataFrame:
    """Per partition the number of rows and a digest of their values, in whatever order and files they are stored.

    The digest adds up two hashes of each row, of columns in name order, so it combines before the
    shuffle; rows that occur twice count twice. Columns are compared by value and type.
    """
    columns = [F.struct(F.lit(name), F.col(name)) for name in sorted(df.columns)]
    row = F.struct(*columns)
    first, second = F.xxhash64(row), F.xxhash64(F.lit("second"), row)
    # Sums of 64-bit numbers as decimals: no overflow however many rows there are.
    total = lambda value: F.sum(value.cast("decimal(20,0)")).cast("string")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"), F.concat_ws("/", total(first), total(second)).alias("digest"))


def compared(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Per partition of either table: rows before and after, and whether it is ``same``, ``changed``, ``added`` or ``dropped``."""
    named = lambda df, side: df.select(*by, F.col("row_count").alias(f"rows_{side}"), F.col("digest").alias(f"digest_{side}"))
    both = named(partition_digests(before, by), "before").join(named(partition_digests(after, by), "after"), by, "full")
    outcome = (
        F.when(F.col("digest_before").isNull(), "added").when(F.col("digest_after").isNull(), "dropped")
        .when(F.col("digest_before") == F.col("digest_after"), "same").otherwise("changed")
    )
    return both.select(*by, "rows_before", "rows_after", outcome.alias("outcome"))
