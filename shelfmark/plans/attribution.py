"""Multi-touch attribution over a look-back window.

A journey is every touch of the customer up to the purchase, no more than 30
days old. Only ``journey_touches`` and ``journey_arrays`` list the single touches,
because that list is what they return. The credit models need no list: they work
on touches per channel and day, so a customer with very many touches costs a few
rows per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.functions import numbers, orderkeys
from shelfmark.operators import journeys as journeys_of
from shelfmark.operators.ranking import with_row_number
from shelfmark.operators.totals import with_running_sums
from shelfmark.session import cut_lineage

# Look-back in days, half-life of the decay in days, position and
# first/last weights.
LOOKBACK_DAYS = 30
HALF_LIFE_DAYS = 7
POSITION_ENDS, POSITION_MIDDLE = 0.4, 0.2
FIRST_WEIGHT, LAST_WEIGHT = 0.45, 0.55

EPOCH = "1970-01-01"


def union_touchpoints(txns: DataFrame, interactions: DataFrame) -> DataFrame:
    """Purchases and interactions as one touch list; ``touch_id`` is unique together with ``event_type``."""
    bought = txns.select(
        "customer_id", F.col("transaction_id").alias("touch_id"), F.col("transaction_timestamp").alias("touch_timestamp"),
        "channel", F.lit(None).cast("bigint").alias("campaign_id"), F.lit("purchase").alias("event_type"),
        F.col("total_amount").alias("revenue"),
        (F.col("total_amount") - F.col("tax_amount") - F.col("shipping_cost")).cast("decimal(12,2)").alias("profit"),
    )
    talked = interactions.select(
        "customer_id", F.col("interaction_id").alias("touch_id"),
        F.col("interaction_timestamp").alias("touch_timestamp"),
        F.col("interaction_type").alias("channel"), F.lit(None).cast("bigint").alias("campaign_id"),
        F.lit("interaction").alias("event_type"),
        F.lit(0).cast("decimal(12,2)").alias("revenue"),
        F.lit(0).cast("decimal(12,2)").alias("profit"),
    )
    return bought.unionByName(talked)


def touch_sequence(touches: DataFrame) -> DataFrame:
    """Running number of the touch within its customer, exact and without one task per customer."""
    return with_row_number(touches, _in_order(), "touchpoint_seq", ["customer_id"])


def _in_order() -> list[Column]:
    """The order of a journey: purchases come after other touches of the same moment."""
    return [F.col("touch_timestamp").asc(), _is_purchase().asc(), F.col("touch_id").asc()]


def _is_purchase() -> Column:
    return (F.col("event_type") == "purchase").cast("int")


def _day_number(ts: str) -> Column:
    return F.date_diff(F.to_date(ts), F.lit(EPOCH).cast("date"))


def _purchases(touches: DataFrame) -> DataFrame:
    return touches.filter("event_type = 'purchase'").select(
        "customer_id", F.col("touch_id").alias("transaction_id"), F.col("touch_timestamp").alias("bought_at"),
        F.col("revenue").alias("transaction_revenue"), *([F.col("profit").alias("transaction_profit")] if "profit" in touches.columns else []),
        _day_number("touch_timestamp").alias("bought_day"),
    )


def _both_blocks(day: str) -> Column:
    """Blocks of 31 days: a touch can matter in its own block and in the next one."""
    block = F.floor(F.col(day) / (LOOKBACK_DAYS + 1))
    return F.explode(F.array(block, block + 1))


def _own_block(day: str) -> Column:
    return F.floor(F.col(day) / (LOOKBACK_DAYS + 1))


def journey_index(touches: DataFrame) -> DataFrame:
    """Touches numbered within their customer, in the order of a journey; touches without a customer or a moment belong to none."""
    return journeys_of.numbered(touches, _in_order(), "touch_timestamp")


def journey_ranges(index: DataFrame) -> DataFrame:
    """Per purchase the first and last number of its journey in the index."""
    found = journeys_of.ranges(index, F.col("event_type") == "purchase", "touch_timestamp", LOOKBACK_DAYS)
    return found.select(
        "customer_id", F.col("touch_id").alias("transaction_id"), F.col("touch_timestamp").alias("bought_at"),
        F.col("revenue").alias("transaction_revenue"), "first", "last",
    )


def journey_touches(touches: DataFrame, size: int = journeys_of.PIECE) -> DataFrame:
    """Purchase by touch rows of every journey, taken out of the index by their numbers."""
    index = journey_index(touches)
    step = F.struct("touch_id", "touch_timestamp", "channel", "campaign_id", "event_type")
    found = journeys_of.cuts(journey_ranges(index), journeys_of.pieces(index, step, size=size), size)
    single = found.withColumn("_step", F.explode("steps")).select(
        "customer_id", "transaction_id", "bought_at", "transaction_revenue", "_step.*")
    return single.withColumn("days_before", _day_number("bought_at") - _day_number("touch_timestamp"))


def journey_arrays(touches: DataFrame, size: int = journeys_of.PIECE) -> DataFrame:
    """The ordered touch list per purchase: the parts of the pieces that its range covers, one after the other."""
    index = journey_index(touches)
    step = F.struct(F.col("channel"), F.col("touch_timestamp").alias("timestamp"), F.col("campaign_id"), F.col("event_type"))
    parts = journeys_of.cuts(journey_ranges(index), journeys_of.pieces(index, step, size=size), size)
    listed = parts.groupBy("transaction_id").agg(F.collect_list(F.struct("_piece", "steps")).alias("_parts"))
    ordered = F.array_sort("_parts", lambda x, y: (x["_piece"] - y["_piece"]).cast("int"))
    return listed.select("transaction_id", F.flatten(F.transform(ordered, lambda p: p["steps"])).alias("journey_touchpoints"))


def channel_counts(touches: DataFrame) -> DataFrame:
    """Per purchase and channel: touches, their decay weight, and the earliest one.

    Days before the purchase day come from daily totals; the purchase day itself
    from a running count up to the moment of the purchase.
    """
    stamped = touches.withColumn("day", _day_number("touch_timestamp"))
    # The earliest touch as a key of fixed width; of one moment, purchases come last.
    place = orderkeys.packed(orderkeys.micros(F.col("touch_timestamp")) * 2 + _is_purchase(), F.col("touch_id"))
    # Written once: the earlier days and the day itself read it.
    daily = cut_lineage(stamped.withColumn("_key", place).groupBy("customer_id", "day", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.min("_key").alias("first"), F.min_by("campaign_id", "_key").alias("campaign")
    ))
    earliest = [F.min("first").alias("first"), F.min_by("campaign", "first").alias("campaign")]
    bought = _purchases(touches)

    days = bought.select("customer_id", "bought_day").distinct().withColumn("_block", _own_block("bought_day"))
    blocks = daily.withColumn("_block", _both_blocks("day"))
    age = F.col("bought_day") - F.col("day")
    weight = F.pow(F.lit(2.0), -age / F.lit(float(HALF_LIFE_DAYS)))
    before = (
        days.join(blocks, ["customer_id", "_block"]).filter((age >= 1) & (age <= LOOKBACK_DAYS))
        .groupBy("customer_id", "bought_day", "channel")
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * weight).alias("w"), *earliest)
    )
    on_earlier_days = bought.join(before, ["customer_id", "bought_day"]).select("transaction_id", "channel", "n", "w", "first", "campaign")

    # The purchase asks, per channel of its day, how many touches there were up to its moment.
    asked = bought.join(
        daily.withColumnRenamed("day", "bought_day"), ["customer_id", "bought_day"]
    ).select(
        "customer_id", F.col("bought_day").alias("day"), "channel", F.col("bought_at").alias("ts"),
        "transaction_id", "first", "campaign", F.lit(0).alias("one"),
    )
    told = stamped.select(
        "customer_id", "day", "channel", F.col("touch_timestamp").alias("ts"),
        F.lit(None).cast("bigint").alias("transaction_id"), F.lit(None).cast("decimal(38,0)").alias("first"),
        F.lit(None).cast("bigint").alias("campaign"), F.lit(1).alias("one"),
    )
    # Purchases ask behind the touches of their very moment, so these count as well.
    running = with_running_sums(
        asked.unionByName(told), ["customer_id", "day", "channel"], [F.col("ts").asc(), F.col("one").desc(), F.col("transaction_id").asc_nulls_first()],
        {"n": F.col("one")},
    )
    on_the_day = running.filter("transaction_id is not null and n > 0").select(
        "transaction_id", "channel", "n", F.col("n").cast("double").alias("w"), "first", "campaign"
    )
    return on_earlier_days.unionByName(on_the_day).groupBy("transaction_id", "channel").agg(
        F.sum("n").alias("touches"), F.round(F.sum("w"), 9).alias("weight"), *earliest
    )


def journeys(touches: DataFrame) -> DataFrame:
    """Per purchase and channel: counts, with the journey's totals, first and last touch attached.

    The window holds one row per channel of a purchase.
    """
    counts = channel_counts(touches)
    whole = Window.partitionBy("transaction_id")
    totals = counts.withColumns(
        {
            "touchpoint_count": F.sum("touches").over(whole),
            "_weight_total": F.sum("weight").over(whole),
            "_start": F.min(F.struct("first", "channel", "campaign")).over(whole),
        }
    )
    # Purchases sort after other touches of the same moment, so the last touch is a purchase: the one with the largest id.
    purchases = touches.filter("event_type = 'purchase'")
    closing = purchases.groupBy("customer_id", F.col("touch_timestamp").alias("bought_at")).agg(F.max("touch_id").alias("_end_id")).join(
        purchases.select(F.col("touch_id").alias("_end_id"), F.struct("channel", "campaign_id").alias("_end")), "_end_id")
    bought = _purchases(touches).join(closing, ["customer_id", "bought_at"])
    return totals.join(bought, "transaction_id").select(
        "transaction_id", "customer_id", "transaction_revenue",
        *(["transaction_profit"] if "profit" in touches.columns else []),
        F.to_date("bought_at").alias("attribution_date"),
        "channel", "touches", "weight", "touchpoint_count", "_weight_total",
        F.col("_start.channel").alias("first_touch_channel"),
        F.col("_start.campaign").alias("first_touch_campaign_id"),
        F.col("_end.channel").alias("last_touch_channel"),
        F.col("_end.campaign_id").alias("last_touch_campaign_id"),
        F.date_diff(F.to_date("bought_at"), F.to_date(F.timestamp_micros(F.floor(orderkeys.major_of(F.col("_start.first")) / 2).cast("bigint")))).alias(
            "journey_length_days"),
    )


def _share(model: str) -> Column:
    touches, total = F.col("touches"), F.col("touchpoint_count")
    is_first = (F.col("channel") == F.col("first_touch_channel")).cast("int")
    is_last = (F.col("channel") == F.col("last_touch_channel")).cast("int")
    if model == "linear":
        return touches / total
    if model == "time_decay":
        return F.col("weight") / F.col("_weight_total")
    if model == "first_last":
        return F.when(total == 1, 1.0).otherwise(is_first * FIRST_WEIGHT + is_last * LAST_WEIGHT)
    if model == "position":
        middle = (touches - is_first - is_last) / F.greatest(total - 2, F.lit(1))
        spread = is_first * POSITION_ENDS + is_last * POSITION_ENDS + middle * POSITION_MIDDLE
        return F.when(total == 1, 1.0).when(total == 2, is_first * 0.5 + is_last * 0.5).otherwise(spread)
    raise ValueError(f"unknown attribution model: {model}")


def with_credit(rows: DataFrame, model: str, name: str = "credit") -> DataFrame:
    """Revenue credited to each channel of a purchase; cents lost to rounding go to the last touch."""
    share = F.round(F.col("transaction_revenue").cast("double") * _share(model), 6)
    rounded = rows.withColumn(name, numbers.as_decimal(share, 12, 2))
    whole = Window.partitionBy("transaction_id")
    rest = F.col("transaction_revenue") - F.sum(name).over(whole)
    at_end = F.col("channel") == F.col("last_touch_channel")
    return rounded.withColumn(
        name, (F.col(name) + F.when(at_end, rest).otherwise(F.lit(0).cast("decimal(12,2)"))).cast("decimal(12,2)")
    )


def credits(rows: DataFrame, model: str) -> DataFrame:
    """(purchase, channel, credit) rows of one model; channels without credit are left out."""
    return with_credit(rows, model).filter("credit <> 0 or transaction_revenue = 0").select(
        "transaction_id", "channel", "credit"
    )


def single_touch(rows: DataFrame, which: str) -> DataFrame:
    """All revenue to the first (or last) touch."""
    return per_purchase(rows).select(
        "transaction_id", "customer_id",
        F.col(f"{which}_touch_channel"), F.col(f"{which}_touch_campaign_id"),
        F.col("transaction_revenue").alias(f"{which}_touch_attribution_revenue"),
    )


def per_purchase(rows: DataFrame) -> DataFrame:
    """One row per purchase: the row of the channel it was closed on."""
    return rows.filter(F.col("channel") == F.col("last_touch_channel")).drop("channel", "touches", "weight", "_weight_total")


MAPS = {"time_decay": "time_decay_attribution_map", "position": "position_based_attribution_map",
        "first_last": "data_driven_attribution_map"}


def channel_attribution(touches: DataFrame) -> DataFrame:
    """One row per purchase with all models and the touch list."""
    # Written once: counts, purchases, closing touches and the index all read the touches.
    touches = cut_lineage(touches)
    # Written once: the maps and the purchases' rows both read it.
    rows = cut_lineage(journeys(touches))
    for model in MAPS:
        rows = with_credit(rows, model, f"_{model}")
    entries = lambda model: F.map_from_entries(
        F.array_sort(F.collect_list(F.when(F.col(f"_{model}") != 0, F.struct("channel", f"_{model}"))))
    )
    maps = rows.groupBy("transaction_id").agg(*[entries(model).alias(name) for model, name in MAPS.items()])
    purchase = per_purchase(rows).drop(*[f"_{model}" for model in MAPS])
    per_touch = numbers.ratio(F.col("transaction_revenue"), F.col("touchpoint_count"))
    return (
        purchase.join(maps, "transaction_id").join(journey_arrays(touches), "transaction_id", "left")
        .withColumns(
            {
                "first_touch_attribution_revenue": F.col("transaction_revenue"),
                "last_touch_attribution_revenue": F.col("transaction_revenue"),
                "linear_attribution_per_touchpoint": numbers.as_decimal(per_touch, 12, 2),
            }
        )
    )


def channel_summary(rows: DataFrame) -> DataFrame:
    """Conversions and revenue by first and by last channel."""
    closed = per_purchase(rows)
    sides = [
        closed.groupBy(F.col(f"{which}_touch_channel").alias("channel")).agg(
            F.count(F.lit(1)).alias("conversions"), numbers.money(F.sum("transaction_revenue")).alias("attributed_revenue")
        ).withColumn("touch", F.lit(which))
        for which in ("first", "last")
    ]
    return sides[0].unionByName(sides[1])


def journey_stats(rows: DataFrame) -> DataFrame:
    return per_purchase(rows).agg(
        F.count(F.lit(1)).alias("conversions"),
        numbers.mean(F.col("journey_length_days")).alias("avg_journey_length"),
        numbers.mean(F.col("touchpoint_count")).alias("avg_touchpoints"),
        F.max("touchpoint_count").alias("max_touchpoints"),
    )
