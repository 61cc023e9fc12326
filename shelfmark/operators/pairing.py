"""Meeting every row of one side with matching rows of the other without hot join groups.

A join group of n rows makes n x n comparisons in one task. Groups above a size
limit are cut into a grid: the left rows pick a line and go to every column, the
right rows pick a column and go to every line. Each pair still meets exactly
once, and no grid cell holds more than about ``limit`` rows of either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import dealt

GRID = ["_line", "_column"]

# Bytes of the baskets' files that one task makes pairs of.
TASK_BYTES = 1 << 20


def hot_groups(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows and the number of cuts they need (at most rows / limit keys)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    return sizes.select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_cuts"))


def on_grid(df: DataFrame, keys: list[str], hot: DataFrame, unique: str, own: str) -> DataFrame:
    """Adds the grid cell columns; ``own`` names the axis this side is cut along."""
    other = GRID[1] if own == GRID[0] else GRID[0]
    cuts = F.coalesce(F.col("_cuts"), F.lit(1))
    return df.join(hot, keys, "left").withColumns(
        {own: F.pmod(F.xxhash64(F.col(unique)), cuts).cast("int"), other: F.explode(F.sequence(F.lit(0), cuts - 1))}
    ).drop("_cuts")


def item_pairs(baskets: DataFrame, order: str, item: str, carried: list[str], limit: int = 512) -> DataFrame:
    """Unordered item pairs ``item_a < item_b`` per order; ``baskets`` has one row per order and item.

    No cell of the grid is large, so cells are dealt to as many tasks as the baskets' files need.
    """
    hot = hot_groups(baskets, [order], limit)
    left = on_grid(baskets, [order], hot, item, GRID[0])
    left = left.select(order, *GRID, F.col(item).alias("item_a"), *carried)
    right = on_grid(baskets, [order], hot, item, GRID[1]).select(order, *GRID, F.col(item).alias("item_b"))
    left, right = (dealt(side, baskets, TASK_BYTES, order, *GRID) for side in (left, right))
    return left.join(right, [order, *GRID]).filter("item_a < item_b").drop(*GRID)
