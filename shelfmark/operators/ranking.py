"""Exact row numbers, ranks and quantile buckets that never put a whole group in one task.

``Window.orderBy`` without a partition, or with one very large partition, sorts
everything in a single task. Here the rows are range-partitioned by (group,
order), so every task gets an equal slice whatever the groups look like. Each
slice numbers its own rows; the rows before a slice are added afterwards from a
small table of slice counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.session import cut_lineage


def in_slices(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """Sorted slices with the slice number and the position in the slice, fixed on disk.

    The slice borders come from sampling, so they are written out once: every
    consumer then sees the same slices, also after an executor is lost.
    """
    keys = [F.col(name).asc_nulls_first() for name in group] + order
    numbered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    # Spark keeps the partition number above bit 33 and the row position below it.
    return cut_lineage(numbered).withColumns(
        {"_slice": F.shiftright("_place", 33), "_place": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))}
    )


def with_row_number(
    df: DataFrame,
    order: list[Column],
    name: str,
    group: list[str] | None = None,
    total: str | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """``row_number() over (partition by group order by order)``, exactly.

    ``order`` has to be total (end with a unique column). With ``total`` the
    group's row count is attached too. ``few_groups`` says that the number of
    groups is a small constant: the table of slice counts then has at most that
    many rows more than there are partitions, and is broadcast.
    """
    group = group or []
    placed = in_slices(df, group, order)
    slices = placed.groupBy("_slice", *group).agg(F.min("_place").alias("_from"), F.count(F.lit(1)).alias("_rows"))
    # One row per slice and group, so this window is never longer than the number of partitions.
    of_group = Window.partitionBy(*group)
    earlier = of_group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = {"_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0))}
    if total:
        counts[total] = F.sum("_rows").over(of_group)
    offsets = slices.withColumns(counts).select(
        F.col("_slice").alias("_s"), *[F.col(g).alias(f"_g_{g}") for g in group], "_from", "_before",
        *([total] if total else []),
    )
    if few_groups or not group:
        offsets = F.broadcast(offsets)
    same = F.col("_slice") == F.col("_s")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    position = F.col("_place") - F.col("_from") + F.col("_before") + 1
    return (
        placed.join(offsets, same, "left").withColumn(name, position.cast("bigint"))
        .drop("_slice", "_s", "_place", "_from", "_before", *[f"_g_{g}" for g in group])
    )


def _bucket(row_number: Column, rows: Column, buckets: int) -> Column:
    """The ``ntile`` of a row number: sizes differ by at most one, larger buckets first."""
    small = F.floor(rows / buckets)
    extra = rows % buckets
    in_large = extra * (small + 1)
    place = row_number - 1
    return (
        F.when(place < in_large, F.floor(place / (small + 1)))
        .otherwise(extra + F.floor((place - in_large) / F.greatest(small, F.lit(1))))
        + 1
    ).cast("int")


def with_places(
    df: DataFrame, key: str, row_numbers: dict[str, Column], ntiles: dict[str, tuple[Column, int]]
) -> DataFrame:
    """Several row numbers and ``ntile`` columns over the whole frame, in one sort.

    Each maps a new column to its ascending numeric sort value; ties go by
    ``key``, which has to be a unique whole number. Only the key and the values are repeated per
    ordering and sorted; the places are joined to the rows by ``key``. ``df`` is read twice and should
    be cheap to read.
    """
    orderings = {**row_numbers, **{name: value for name, (value, _) in ntiles.items()}}
    repeats = F.array(*[
        F.struct(F.lit(name).alias("_order"), value.cast("decimal(38,6)").alias("_value"))
        for name, value in orderings.items()
    ])
    stacked = df.select(key, F.explode(repeats).alias("_r")).select(key, "_r._order", "_r._value")
    order = [F.col("_value").asc_nulls_first(), F.col(key).asc_nulls_first()]
    placed = with_row_number(stacked, order, "_rn", ["_order"], total="_n", few_groups=True)
    columns = []
    for name in orderings:
        value = F.col("_rn") if name in row_numbers else _bucket(F.col("_rn"), F.col("_n"), ntiles[name][1])
        columns.append(F.max(F.when(F.col("_order") == name, value)).alias(name))
    places = placed.groupBy(F.col(key).alias("_key")).agg(*columns)
    return df.join(places, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def with_dense_rank(df: DataFrame, value: str, name: str, group: list[str]) -> DataFrame:
    """Descending ``dense_rank()`` by one value column within each group; NULL values come last.

    The distinct values of a group are numbered, then joined back by value: ties
    share a number, and tied rows collapse before they are numbered. ``df`` is
    read twice and should be cheap to read.
    """
    distinct = df.select(*group, value).distinct()
    ranks = with_row_number(distinct, [F.col(value).desc_nulls_last()], name, group)
    ranks = ranks.select(*[F.col(c).alias(f"_r_{c}") for c in [*group, value]], F.col(name).cast("int").alias(name))
    same = F.col(value).eqNullSafe(F.col(f"_r_{value}"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_r_{g}"))
    return df.join(ranks, same, "left").drop(*[f"_r_{c}" for c in [*group, value]])


def with_dense_ranks(
    df: DataFrame, key: str | list[str], ranks: dict[str, tuple[str, str | list[str] | None]], of: DataFrame | None = None
) -> DataFrame:
    """Several descending dense ranks in one sort; NULL values come last.

    ``ranks`` maps a new column to (value column, group column or columns or None); ``key``,
    one column or several, is unique; nulls count as a value. Only keys, groups and values are
    repeated per rank and sorted. Each slice ranks its own values; the distinct values of the slices before
    it are added, less one wherever a slice goes on with the value that the one before ended with. ``of``
    may give the same rows in a form that is cheaper to read.
    """
    keys = [key] if isinstance(key, str) else key
    lists = {name: [group] if isinstance(group, str) else group or [] for name, (_, group) in ranks.items()}
    shared = next(iter(lists.values()))
    alike = all(group == shared for group in lists.values())
    fields = shared if alike else ["_group"]

    def entry(name: str) -> Column:
        own = [F.col(g).alias(f"_g{i}") for i, g in enumerate(shared)] if alike else [
            (F.to_json(F.struct(*lists[name])) if lists[name] else F.lit(None).cast("string")).alias("_g0")]
        return F.struct(F.lit(name).alias("_rank"), *own, F.col(ranks[name][0]).cast("decimal(38,6)").alias("_value"))

    groups = ["_rank", *[f"_g{i}" for i in range(len(fields))]]
    named = [f"_k{i}" for i in range(len(keys))]
    source = df if of is None else of
    stacked = source.select(*[F.col(k).alias(n) for k, n in zip(keys, named)], F.explode(F.array(*map(entry, ranks))).alias("_e")).select(*named, "_e.*")
    order = F.col("_value").desc_nulls_last()
    inside = Window.partitionBy("_slice", *groups).orderBy(order)
    local = in_slices(stacked, groups, [order]).withColumn("_local", F.dense_rank().over(inside))
    ends = local.groupBy("_slice", *groups).agg(
        F.max("_local").alias("_n"), F.max("_value").alias("_first"),
        F.when(F.count("_value") == F.count(F.lit(1)), F.min("_value")).alias("_last"),
    )
    of_group = Window.partitionBy(*groups).orderBy("_slice")
    goes_on = (F.lag("_n").over(of_group).isNotNull() & F.col("_first").eqNullSafe(F.lag("_last").over(of_group))).cast("int")
    # One row per slice and group, so these windows are no longer than the number of slices.
    offsets = ends.withColumn("_goes_on", goes_on).select(
        F.col("_slice").alias("_s"), *[F.col(g).alias(f"_o{g}") for g in groups],
        (F.sum("_n").over(of_group) - F.col("_n") - F.sum("_goes_on").over(of_group)).alias("_offset"),
    )
    same = F.col("_slice") == F.col("_s")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_o{g}"))
    placed = local.join(offsets, same).groupBy(*named).agg(
        *[F.max(F.when(F.col("_rank") == name, F.col("_local") + F.col("_offset"))).cast("int").alias(name) for name in ranks])
    here = F.lit(True)
    for k, n in zip(keys, named):
        here = here & F.col(k).eqNullSafe(F.col(n))
    return df.join(placed, here, "left").drop(*named)


def with_neighbour(
    df: DataFrame, order: list[Column], columns: dict[str, str], group: list[str], following: bool = False
) -> DataFrame:
    """``lag`` (or ``lead``) of ``columns`` (source -> new name) within each group.

    Inside a slice the neighbour is the adjacent row; across a slice border it is
    the last (first) row of the same group in the nearest earlier (later) slice.
    """
    placed = in_slices(df, group, order)
    near = Window.partitionBy("_slice", *group).orderBy("_place")
    step = F.lead if following else F.lag
    packed = F.struct(*[F.col(source).alias(new) for source, new in columns.items()])
    local = placed.withColumn("_near", step(packed).over(near))
    edge = F.min_by if following else F.max_by
    edges = placed.groupBy("_slice", *group).agg(edge(packed, "_place").alias("_edge"))
    across = Window.partitionBy(*group).orderBy("_slice")
    carried = edges.select(
        F.col("_slice").alias("_s"), *[F.col(g).alias(f"_g_{g}") for g in group],
        step("_edge").over(across).alias("_far"),
    )
    same = F.col("_slice") == F.col("_s")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    found = F.coalesce(F.col("_near"), F.col("_far"))
    return (
        local.join(carried, same, "left")
        .withColumns({new: found.getField(new) for new in columns.values()})
        .drop("_slice", "_s", "_place", "_near", "_far", *[f"_g_{g}" for g in group])
    )
