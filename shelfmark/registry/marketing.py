"""Campaign and attribution queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import silver
from shelfmark.plans import attribution, campaigns
from shelfmark.registry.customers import mart
from shelfmark.registry.layers import RUN_TIME, TIME_TEXT
from shelfmark.sources import shapes

MICRO_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def events_as_of():
    return shapes.day(shapes.EVENTS_AS_OF)


def campaign_feed(spark, folder):
    return silver.campaigns_from_raw(shapes.raw_marketing_campaigns(spark, folder), F.lit(RUN_TIME))


def event_feed(spark, folder):
    return silver.campaign_events_from_raw(shapes.raw_campaign_events(spark, folder), F.lit(RUN_TIME))


# --- campaigns --------------------------------------------------------------

def coupon_explode(spark, folder):
    return campaigns.coupon_rows(shapes.transactions_flagged(spark, folder)).select(
        "transaction_id", "coupon_code", "campaign_id", "channel", "total_amount")


def campaign_vs_organic(spark, folder):
    rows = campaigns.campaign_and_organic(shapes.transactions_flagged(spark, folder))
    return campaigns.attributed(rows)


def campaign_funnel(spark, folder):
    return campaigns.funnel(event_feed(spark, folder))


def priced(spark, folder):
    measured = campaigns.attributed(campaigns.campaign_and_organic(shapes.transactions_flagged(spark, folder)))
    return campaigns.unit_economics(measured, campaign_feed(spark, folder), event_feed(spark, folder), events_as_of())


def campaign_unit_economics(spark, folder):
    return priced(spark, folder).select(
        *campaigns.KEYS, "campaign_name", "campaign_type", "total_budget", "actual_spend", "total_impressions",
        "total_clicks", "total_conversions", "click_through_rate", "conversion_rate", "budget_utilization_rate",
        "cost_per_impression", "cost_per_click", "cost_per_acquisition", "roi_percentage", "roas",
        "revenue_per_impression", "profit_per_dollar_spent", "avg_clv_of_acquired_customers", "estimated_lifetime_roi")


def campaign_incremental(spark, folder):
    txns = shapes.transactions_flagged(spark, folder)
    measured = campaigns.attributed(campaigns.campaign_and_organic(txns))
    return campaigns.with_increment(measured, txns).select(*campaigns.KEYS, "incremental_revenue", "incremental_profit")


def roi_vs_channel(spark, folder):
    return campaigns.vs_channel(priced(spark, folder)).select(*campaigns.KEYS, "roi_percentage", "roi_vs_channel_avg")


def campaign_rank(spark, folder):
    return campaigns.vs_channel(priced(spark, folder)).select(
        *campaigns.KEYS, "attributed_revenue", "performance_rank_in_channel")


def gold_campaign_roi(spark, folder):
    rows = campaigns.campaign_roi(
        shapes.transactions_flagged(spark, folder), campaign_feed(spark, folder), event_feed(spark, folder), events_as_of())
    return mart(rows, "campaign_roi_analysis")


def topk_nulls_last(spark, folder):
    return campaigns.top_campaigns(priced(spark, folder))


def campaign_summary(spark, folder):
    return campaigns.campaign_summary(priced(spark, folder))


# --- attribution ------------------------------------------------------------

def touchpoint_union(spark, folder):
    union = attribution.union_touchpoints(shapes.transactions(spark, folder), shapes.customer_interactions(spark, folder))
    return union.withColumn("touch_timestamp", F.date_format("touch_timestamp", TIME_TEXT))


def touchpoint_seq(spark, folder):
    return attribution.touch_sequence(shapes.touchpoints(spark, folder)).select("customer_id", "touch_id", "touchpoint_seq")


def journey_lookback(spark, folder):
    return attribution.journey_touches(shapes.touchpoints(spark, folder)).select(
        "transaction_id", "touch_id", "channel", "days_before")


def journey_collect(spark, folder):
    steps = F.transform("journey_touchpoints", lambda s: F.concat_ws(
        "@", s["channel"], F.date_format(s["timestamp"], MICRO_TIME), s["campaign_id"].cast("string"), s["event_type"]))
    return attribution.journey_arrays(shapes.touchpoints(spark, folder)).select(
        "transaction_id", F.size("journey_touchpoints").alias("touches"), F.array_join(steps, ";").alias("journey"))


def journeys(spark, folder):
    return attribution.journeys(shapes.touchpoints(spark, folder))


def attr_first_touch(spark, folder):
    return attribution.single_touch(journeys(spark, folder), "first")


def attr_last_touch(spark, folder):
    return attribution.single_touch(journeys(spark, folder), "last")


def attr_linear(spark, folder):
    return attribution.credits(journeys(spark, folder), "linear")


def attr_time_decay(spark, folder):
    return attribution.credits(journeys(spark, folder), "time_decay")


def attr_position(spark, folder):
    return attribution.credits(journeys(spark, folder), "position")


def attr_weighted_45_55(spark, folder):
    return attribution.credits(journeys(spark, folder), "first_last")


def attr_channel_summary(spark, folder):
    return attribution.channel_summary(journeys(spark, folder))


def journey_stats(spark, folder):
    return attribution.journey_stats(journeys(spark, folder))


def _map_text(name):
    entries = F.array_sort(F.map_entries(name))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";")


def gold_attribution(spark, folder):
    touches = attribution.union_touchpoints(shapes.transactions(spark, folder), shapes.dated_interactions(spark, folder))
    rows = mart(attribution.channel_attribution(touches), "channel_attribution")
    return rows.withColumns(
        {**{name: _map_text(name) for name in attribution.MAPS.values()},
         "journey_touchpoints": F.array_join(F.transform("journey_touchpoints", lambda s: s["channel"]), ";")})


QUERIES = {
    f.__name__: f
    for f in (
        coupon_explode, campaign_vs_organic, campaign_funnel, campaign_unit_economics, campaign_incremental,
        roi_vs_channel, campaign_rank, gold_campaign_roi, topk_nulls_last, campaign_summary, touchpoint_union,
        touchpoint_seq, journey_lookback, journey_collect, attr_first_touch, attr_last_touch, attr_linear,
        attr_time_decay, attr_position, attr_weighted_45_55, attr_channel_summary, journey_stats, gold_attribution,
    )
}
