"""Running sums and group totals that never put a whole group in one task.

A window with an order gathers a group in one task to add it up. Here the rows are cut into
sorted slices of equal size, whatever the groups look like; each slice adds up its own rows,
and the sums of the slices before it are carried in from a small table. Totals of whole
groups come from an aggregate, combined before its shuffle, that is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.ranking import in_slices


def _same(names: list[str], prefix: str) -> Column:
    same = F.lit(True)
    for name in names:
        same = same & F.col(name).eqNullSafe(F.col(f"{prefix}{name}"))
    return same


def with_group_totals(df: DataFrame, group: list[str], totals: dict[str, Column], of: DataFrame | None = None) -> DataFrame:
    """Aggregates over each group on each of its rows, as ``over (partition by group)``; null keys are a group.

    ``of`` may give the same rows in a form that is cheaper to read.
    """
    summed = (df if of is None else of).groupBy(*group).agg(*[total.alias(name) for name, total in totals.items()])
    summed = summed.select(*[F.col(name).alias(f"_t_{name}") for name in group], *totals)
    return df.join(summed, _same(group, "_t_")).drop(*[f"_t_{name}" for name in group])


def with_running_sums(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``sum(value) over (partition by group order by order rows unbounded preceding)`` for each new column.

    ``order`` has to be total, or rows that draw level have to be alike. A sum of nulls only is null.
    """
    values = {f"_v_{name}": value for name, value in sums.items()}
    placed = in_slices(df.withColumns(values), group, order)
    inside = Window.partitionBy("_slice", *group).orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per slice and group: no longer than the number of partitions within a group.
    slices = placed.groupBy("_slice", *group).agg(*[F.sum(f"_v_{name}").alias(f"_c_{name}") for name in sums])
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(F.col("_slice").alias("_s"), *[F.col(name).alias(f"_t_{name}") for name in group],
                            *[F.sum(f"_c_{name}").over(earlier).alias(f"_c_{name}") for name in sums])
    own = placed.withColumns({name: F.sum(f"_v_{name}").over(inside) for name in sums})
    joined = own.join(carried, (F.col("_slice") == F.col("_s")) & _same(group, "_t_"))
    both = {name: F.when(F.col(name).isNotNull() | F.col(f"_c_{name}").isNotNull(),
                         F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_c_{name}"), F.lit(0))) for name in sums}
    return joined.withColumns(both).drop("_slice", "_place", "_s", *values, *[f"_t_{name}" for name in group], *[f"_c_{name}" for name in sums])
