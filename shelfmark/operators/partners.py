"""The most frequent partners of each item, without counting the pairs of large baskets.

Pairs of orders up to ``large`` items are counted as they are: at most that many rows a line.
In larger orders a threshold decides what is worth counting. A few partners of each item,
taken from every order, show a count ``floor`` that its k-th best partner reaches at least. So an
item may skip its ``floor`` largest orders when partners are looked up:

- a partner met in an order that is not skipped is counted exactly, in the skipped ones by a
  lookup of (order, partner);
- any other partner meets the item in skipped orders only, at most ``floor`` times. It can only
  draw level, and only if it stands in all skipped orders. Of those the smallest ids win, and they
  are the same for all items that skip the same orders: they are found once per set of orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.pairing import GRID, hot_groups, on_grid
from shelfmark.session import cut_lineage

LARGE = 64  # items of an order beyond which its pairs are not all counted
CELL = 512  # rows of a grid cell of a large order


def top_partners(held: DataFrame, k: int, order: str = "transaction_id", item: str = "item", large: int = LARGE) -> DataFrame:
    """``item``, ``rank``, ``partner``, ``orders``: the ``k`` items that share most orders, smaller ids first among equals.

    ``held`` has one row per order and item, both not null.
    """
    rows = held.select(F.col(order).alias("o"), F.col(item).alias("a"))
    sized = cut_lineage(rows.join(rows.groupBy("o").agg(F.count("*").alias("size")), "o"))
    small, big = sized.where(F.col("size") <= large), sized.where(F.col("size") > large)
    # Counted in one direction, then given in both.
    once = small.select("o", "a").join(small.select("o", F.col("a").alias("b")), "o").where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))
    met = once.select(F.inline(F.array(F.struct("a", "b", "n"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "n"))))
    if not big.isEmpty():
        met = cut_lineage(met)
        met = _with_large(met, cut_lineage(big), sized, k)
    best = Window.partitionBy("a").orderBy(F.desc("n"), "b")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("a").alias(item), "rank", F.col("b").alias("partner"), F.col("n").alias("orders"))


def _with_large(met: DataFrame, big: DataFrame, sized: DataFrame, k: int) -> DataFrame:
    """Counts of every pair that can be among the ``k`` best, large orders included; ``met`` has those of the small ones."""
    orders = sized.groupBy("a").agg(F.count("*").alias("orders"))
    floors = _floors(met, big.join(orders, "a"), k)
    place = Window.partitionBy("a").orderBy(F.desc("size"), "o")
    # An item with fewer partners than wanted skips no order.
    floored = big.join(floors, "a", "left").withColumn("floor", F.coalesce("floor", F.lit(0)))
    placed = cut_lineage(floored.withColumn("skipped", F.row_number().over(place) <= F.col("floor")))
    skipped, kept = placed.where("skipped"), placed.where("not skipped")

    hot = hot_groups(big, ["o"], CELL)
    left = on_grid(kept.select("o", "a", "floor"), ["o"], hot, "a", GRID[0])
    right = on_grid(big.select("o", F.col("a").alias("b")), ["o"], hot, "b", GRID[1]).join(
        orders.select(F.col("a").alias("b"), F.col("orders").alias("at_most")), "b")
    # A partner of fewer orders than the floor cannot win.
    counted = left.join(right, ["o", *GRID]).where("a <> b and at_most >= floor").groupBy("a", "b").agg(F.count("*").alias("n"))
    known = cut_lineage(met.unionByName(counted).groupBy("a", "b").agg(F.sum("n").alias("n")))

    members = big.select("o", F.col("a").alias("b"))
    looked_up = (known.join(big.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b")
                 .join(skipped.select("a", "o"), "a").join(members, ["o", "b"]).groupBy("a", "b").agg(F.count("*").alias("n")))
    exact = known.unionByName(looked_up).groupBy("a", "b").agg(F.sum("n").alias("n"))
    # Found both ways, a partner has its exact count, which is the larger one.
    return exact.unionByName(_level(skipped, members, k)).groupBy("a", "b").agg(F.max("n").alias("n"))


def _floors(met: DataFrame, big: DataFrame, k: int) -> DataFrame:
    """Per item of a large order a count that its k-th best partner reaches: the small orders' counts, and a few partners of each large order."""
    few = k + 1
    picks = [Window.partitionBy("o").orderBy("a"), Window.partitionBy("o").orderBy(F.desc("orders"), "a")]
    seeds = None
    for pick in picks:
        rows = big.withColumn("place", F.row_number().over(pick)).where(F.col("place") <= few).select("o", F.col("a").alias("b"))
        seeds = rows if seeds is None else seeds.union(rows).distinct()
    shown = big.select("o", "a").join(seeds, "o").where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))
    own = met.join(big.select("a").distinct(), "a", "left_semi")
    lower = own.unionByName(shown).groupBy("a", "b").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("a").orderBy(F.desc("n"))
    return (lower.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
            .groupBy("a").agg(F.min("n").alias("floor"), F.max("place").alias("found")).where(F.col("found") == k).select("a", "floor"))


def _level(skipped: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """Per item the smallest ids that stand in all of its skipped orders, if these are as many as its floor."""
    sets = (skipped.groupBy("a", "floor").agg(F.sort_array(F.collect_list(F.struct("size", "o"))).alias("set"))
            .where(F.size("set") == F.col("floor")).select("a", "floor", F.transform("set", lambda x: x["o"]).alias("set")))
    sets = cut_lineage(sets)
    distinct = sets.select("set").distinct()
    # The members of the smallest order of a set, looked up in its other orders.
    first = distinct.select("set", F.get("set", F.lit(0)).alias("o")).join(members, "o").select("set", "b")
    others = (first.where(F.size("set") > 1).withColumn("o", F.explode(F.slice("set", 2, F.size("set") - 1)))
              .join(members, ["o", "b"]).groupBy("set", "b").agg(F.count("*").alias("n"))
              .where(F.col("n") == F.size("set") - 1).select("set", "b"))
    common = first.where(F.size("set") == 1).unionByName(others)
    smallest = Window.partitionBy("set").orderBy("b")
    wanted = common.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1).select("set", "b")
    return sets.join(wanted, "set").where("a <> b").select("a", "b", F.col("floor").alias("n"))
