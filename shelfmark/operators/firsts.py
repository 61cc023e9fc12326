"""First rows, latest rows and best rows per key, without sorting any one key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import orderkeys
from shelfmark.operators.names import numbered, with_name, with_number
from shelfmark.session import cut_lineage


def with_first_purchase(
    txns: DataFrame,
    customer: str = "customer_id",
    ts: str = "transaction_timestamp",
    key: str = "transaction_id",
    flag: str = "is_first_purchase",
) -> DataFrame:
    """Marks each customer's earliest transaction, ties going to the smaller id.

    The earliest (time, id) is a partial aggregate over keys of fixed width, so a customer
    with a third of all rows costs one number per map task. The marker is joined back on the
    transaction id, which is evenly spread whatever the customers look like.
    """
    place = orderkeys.by_time(F.col(ts), F.col(key))
    firsts = txns.filter(F.col(ts).isNotNull()).groupBy(customer).agg(F.min(place).alias("_first")).select(
        orderkeys.minor_of(F.col("_first")).alias(key), "_first")
    here = F.coalesce(place == F.col("_first"), F.lit(False))
    return txns.join(firsts, key, "left").withColumn(flag, here).drop("_first")


def dedupe_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns.

    ``max_by`` keeps one row per key and map task, so heavy duplication of one
    key is collapsed before the shuffle.
    """
    others = [name for name in df.columns if name not in keys]
    rank = F.struct(*[F.col(name) for name in order], F.xxhash64(*[F.col(n) for n in others]))
    kept = F.max_by(F.struct(*others), rank).alias("_row")
    return df.groupBy(*keys).agg(kept).select(*keys, "_row.*").select(*df.columns)


def clean_feed(df: DataFrame, keys: list[str], positive: list[str], trimmed: list[str]) -> DataFrame:
    """Deduplicate, keep rows whose ``positive`` amounts are above zero, trim text, drop audit columns."""
    kept = dedupe_latest(df, keys, ["_ingestion_timestamp", "_record_offset"])
    for name in positive:
        kept = kept.filter(F.col(name).try_cast("decimal(20,4)") > 0)
    audit = [name for name in kept.columns if name.startswith("_")]
    return kept.withColumns({name: F.trim(name) for name in trimmed}).drop(*audit)


def top_value(weights: DataFrame, key: str, value: str, weight: str, name: str) -> DataFrame:
    """Per ``key``: the ``value`` with the greatest total ``weight`` (a whole number), ties to the smaller value.

    Two partial aggregates, no window: (key, value) totals first, then the best of them, compared as
    keys of fixed width with the values' numbers in them.
    """
    totals = cut_lineage(weights.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.sum(weight).alias("_weight")))
    values = numbered(totals, value)
    place = orderkeys.packed(-F.col("_weight"), F.col("_value"))
    best = with_number(totals, values, value, "_value").groupBy(key).agg(orderkeys.minor_of(F.min(place)).alias("_value"))
    return with_name(best, values, "_value", name).select(key, name)
