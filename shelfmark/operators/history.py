"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.ranking import in_slices


def scd2_history(versions: DataFrame, key: str, arrived: str, tracked: list[str]) -> DataFrame:
    """Turn successive versions of a key into effective intervals.

    Versions that repeat the previous values are skipped. An interval ends where
    the next one starts; the open one is current. Several versions with the same
    arrival count as one, the greatest by value.

    One range sort cuts the versions into slices, whatever number a key has. A slice
    finds its own changes; a small table carries, per slice and key, the last values over to
    the next slice and the first change back to the slices before. That settles both
    whether a slice's first version is a change and where its last interval ends.
    """
    single = versions.groupBy(key, arrived).agg(F.max(F.struct(*tracked)).alias("_values"))
    placed = in_slices(single, [key], [F.col(arrived).asc()])
    inside = Window.partitionBy("_slice", key).orderBy("_place")
    before = F.lag("_values").over(inside)
    marked = placed.withColumn("_opens", before.isNull()).withColumn("_changes", ~F.col("_opens") & ~F.col("_values").eqNullSafe(before))
    carried = _carried(marked, key, arrived)
    # The first version of a slice stays if it differs from the last one before; the others as the slice has found.
    kept = marked.filter(F.col("_opens") | F.col("_changes")).withColumn("_next", F.lead(arrived).over(inside))
    joined = kept.join(carried, (F.col("_slice") == F.col("_s")) & F.col(key).eqNullSafe(F.col("_k")))
    until = F.coalesce("_next", "_later")
    return joined.filter(F.col("_changes") | F.col("_differs")).select(
        key, "_values.*",
        F.col(arrived).alias("effective_start_date"),
        until.alias("effective_end_date"),
        until.isNull().alias("is_current"),
    )


def _carried(marked: DataFrame, key: str, arrived: str) -> DataFrame:
    """Per slice and key: whether its first version differs from the version before, and the first change in later slices.

    One row per slice and key, so the windows are no longer than the number of slices that a key is spread over.
    """
    ends = marked.groupBy("_slice", key).agg(
        F.min_by("_values", "_place").alias("_first"), F.max_by("_values", "_place").alias("_last"), F.min(arrived).alias("_from"),
        F.min(F.when(F.col("_changes"), F.col(arrived))).alias("_inner"),
    )
    of_key = Window.partitionBy(key)
    earlier = F.lag("_last").over(of_key.orderBy("_slice"))
    told = ends.withColumn("_differs", earlier.isNull() | ~F.col("_first").eqNullSafe(earlier))
    told = told.withColumn("_change", F.when(F.col("_differs"), F.col("_from")).otherwise(F.col("_inner")))
    # Backwards in time the running minimum of the changes is the next one.
    later = F.min("_change").over(of_key.orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1))
    return told.select(F.col("_slice").alias("_s"), F.col(key).alias("_k"), "_differs", later.alias("_later"))
