"""Campaign return on investment, from coupons on orders and from the marketing feeds.

A campaign row is one coupon code in one sales channel. Budget, impressions and
clicks belong to a whole campaign; they are split over its rows by attributed
orders. Spend is the budget paced evenly over the flight up to the reporting day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import ladders, numbers, text
from shelfmark.operators.ranking import with_dense_rank
from shelfmark.operators.totals import with_group_totals
from shelfmark.session import cut_lineage

# The control group, lifetime factor, profit share of the organic baseline.
ORGANIC_CODE, ORGANIC_ID = "ORGANIC", 0
CLV_ORDERS = 5
BASELINE_PROFIT_SHARE = 0.3

KEYS = ["campaign_id", "coupon_code", "channel"]
FACTS = ["transaction_id", "customer_id", "channel", "transaction_date", "total_amount", "tax_amount", "shipping_cost",
         "is_first_purchase"]


def coupon_rows(txns: DataFrame) -> DataFrame:
    """One row per order and distinct coupon code; the campaign number is the code's digits, if any."""
    used = txns.filter(text.has_entries(F.col("coupon_codes")))
    return used.select(*FACTS, F.explode(F.array_distinct("coupon_codes")).alias("coupon_code")).withColumn(
        "campaign_id", text.code_to_id(F.col("coupon_code"))
    )


def organic_rows(txns: DataFrame) -> DataFrame:
    return txns.filter(~text.has_entries(F.col("coupon_codes"))).select(
        *FACTS, F.lit(ORGANIC_CODE).alias("coupon_code"), F.lit(ORGANIC_ID).cast("bigint").alias("campaign_id")
    )


def campaign_and_organic(txns: DataFrame) -> DataFrame:
    return coupon_rows(txns).unionByName(organic_rows(txns), allowMissingColumns=True)


def attributed(rows: DataFrame) -> DataFrame:
    """Orders, customers, revenue and profit per campaign row, counted through customers first."""
    total, first = F.col("total_amount"), F.col("is_first_purchase")
    profit = total - F.col("tax_amount") - F.col("shipping_cost")
    zero = F.lit(0).cast("decimal(12,2)")
    per_customer = rows.groupBy(*KEYS, "customer_id").agg(
        F.count("transaction_id").alias("orders"),
        F.sum(total).alias("revenue"),
        F.sum(profit).alias("profit"),
        F.sum(F.when(first, total).otherwise(zero)).alias("new_revenue"),
        F.sum(F.when(~first, total).otherwise(zero)).alias("old_revenue"),
        F.count_if(first).alias("acquired"),
        F.min("transaction_date").alias("start_date"),
        F.max("transaction_date").alias("end_date"),
    )
    return per_customer.groupBy(*KEYS).agg(
        numbers.whole(F.sum("orders")).alias("attributed_transactions"),
        F.count("customer_id").alias("unique_customers_reached"),
        numbers.money(F.sum("revenue")).alias("attributed_revenue"),
        numbers.money(F.sum("profit")).alias("attributed_profit"),
        numbers.money(F.sum("new_revenue")).alias("new_customer_revenue"),
        numbers.money(F.sum("old_revenue")).alias("existing_customer_revenue"),
        numbers.whole(F.sum("acquired")).alias("new_customer_acquisitions"),
        F.min("start_date").alias("start_date"),
        F.max("end_date").alias("end_date"),
    ).withColumns(
        {
            "avg_transaction_value": numbers.ratio(F.col("attributed_revenue"), F.col("attributed_transactions")),
            "campaign_duration_days": F.date_diff("end_date", "start_date") + 1,
        }
    )


def funnel(events: DataFrame) -> DataFrame:
    """Impressions, clicks and conversions per campaign from the event feed."""
    kind = F.col("event_type")
    per_customer = events.groupBy("campaign_id", "customer_id").agg(
        F.count_if(kind == "impression").alias("impressions"),
        F.count_if(kind == "click").alias("clicks"),
        F.count_if(kind == "conversion").alias("conversions"),
        F.count_if(kind == "unsubscribe").alias("unsubscribes"),
        F.sum("attributed_revenue").alias("revenue"),
    )
    counted = per_customer.groupBy("campaign_id").agg(
        F.count("customer_id").alias("customers_reached"),
        *[numbers.whole(F.sum(name)).alias(name) for name in ("impressions", "clicks", "conversions", "unsubscribes")],
        numbers.money(F.sum("revenue")).alias("event_revenue"),
    )
    return counted.withColumns(
        {
            "click_through_rate": numbers.percent(F.col("clicks"), F.col("impressions")),
            "conversion_rate": numbers.percent(F.col("conversions"), F.col("clicks")),
        }
    )


def spend(campaigns: DataFrame, as_of: Column) -> DataFrame:
    """Budget and the part of it spent by ``as_of``."""
    passed = F.greatest(F.least(F.date_diff(as_of, F.col("start_date")) + 1, F.col("duration_days")), F.lit(0))
    paid = numbers.as_decimal(
        F.round(F.try_divide(F.col("budget").cast("double") * passed, F.col("duration_days").cast("double")), 6), 18, 2
    )
    return campaigns.select("campaign_id", F.col("budget").alias("campaign_budget"), paid.alias("campaign_spend"))


def unit_economics(measured: DataFrame, campaigns: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """Shares of budget, spend, impressions and clicks, and the costs and returns that follow."""
    is_organic = F.col("coupon_code") == ORGANIC_CODE
    orders = F.col("attributed_transactions")
    # Codes without a number have no campaign to share in, but count as one group.
    measured = with_group_totals(cut_lineage(measured), ["campaign_id"], {"_orders": F.sum(F.when(~is_organic, orders))})
    share = F.when(~is_organic, orders.cast("double") / F.col("_orders"))
    feeds = spend(campaigns, as_of).join(
        funnel(events).select("campaign_id", "impressions", "clicks"), "campaign_id", "full"
    )
    cents = lambda name: F.when(is_organic, F.lit(0).cast("decimal(18,2)")).otherwise(
        numbers.as_decimal(F.round(F.col(name).cast("double") * F.col("_share"), 6), 18, 2)
    )
    units = lambda name: F.round(F.round(F.col(name).cast("double") * F.col("_share"), 6)).cast("bigint")
    allotted = measured.withColumn("_share", share).join(feeds, "campaign_id", "left").withColumns(
        {
            "total_budget": cents("campaign_budget"),
            "actual_spend": cents("campaign_spend"),
            "total_impressions": units("impressions"),
            "total_clicks": units("clicks"),
            "total_conversions": orders,
            "campaign_name": F.when(is_organic, "Organic Traffic").otherwise(
                F.concat(F.lit("Campaign_"), F.coalesce(F.col("campaign_id").cast("string"), F.lit("")), F.lit("_"),
                         F.col("coupon_code"))
            ),
            "campaign_type": ladders.campaign_type(is_organic, F.col("channel")),
        }
    ).drop("_share", "_orders", "campaign_budget", "campaign_spend", "impressions", "clicks")
    paid, revenue, profit = F.col("actual_spend"), F.col("attributed_revenue"), F.col("attributed_profit")
    shown, clicked = F.col("total_impressions"), F.col("total_clicks")
    lifetime = F.col("avg_transaction_value") * CLV_ORDERS
    return allotted.withColumns(
        {
            "click_through_rate": numbers.percent(clicked, shown),
            "conversion_rate": numbers.percent(orders, clicked),
            "budget_utilization_rate": numbers.percent(paid, F.col("total_budget")),
            "cost_per_impression": numbers.ratio(paid, shown),
            "cost_per_click": numbers.ratio(paid, clicked),
            "cost_per_acquisition": numbers.ratio(paid, F.col("new_customer_acquisitions")),
            "roi_percentage": numbers.percent(profit - paid, paid),
            "roas": numbers.ratio(revenue, paid),
            "revenue_per_impression": numbers.ratio(revenue, shown),
            "profit_per_dollar_spent": numbers.ratio(profit, paid),
            "avg_clv_of_acquired_customers": F.round(lifetime, 6),
            "estimated_lifetime_roi": numbers.percent(lifetime * F.col("new_customer_acquisitions"), paid),
        }
    )


def with_increment(measured: DataFrame, txns: DataFrame) -> DataFrame:
    """Revenue and profit above the mean organic revenue per sales channel."""
    organic = organic_rows(txns).groupBy("channel").agg(F.sum("total_amount").alias("revenue"))
    baseline = organic.agg(numbers.mean(F.col("revenue")).alias("b")).scalar()
    above = lambda name, factor: numbers.as_decimal(
        F.round(F.col(name).cast("double") - F.coalesce(F.col("_baseline"), F.lit(0.0)) * factor, 6), 18, 2
    )
    return measured.withColumn("_baseline", baseline).withColumns(
        {
            "incremental_revenue": above("attributed_revenue", 1.0),
            "incremental_profit": above("attributed_profit", BASELINE_PROFIT_SHARE),
        }
    ).drop("_baseline")


def vs_channel(rows: DataFrame) -> DataFrame:
    """Distance to the channel's mean return and revenue rank in the channel.

    The number of coupon codes is open, so neither is a window over a channel.
    """
    fixed = cut_lineage(rows)
    channel = fixed.groupBy("channel").agg(
        numbers.mean(F.col("roi_percentage").cast("decimal(30,6)")).alias("_channel_roi")
    )
    compared = fixed.join(channel, "channel", "left").withColumn(
        "roi_vs_channel_avg", F.round(F.col("roi_percentage") - F.col("_channel_roi"), 6)
    )
    return with_dense_rank(compared.drop("_channel_roi"), "attributed_revenue", "performance_rank_in_channel", ["channel"])


def campaign_roi(txns: DataFrame, campaigns: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """One row per campaign number, coupon code and sales channel."""
    measured = attributed(campaign_and_organic(txns))
    priced = unit_economics(with_increment(measured, txns), campaigns, events, as_of)
    return vs_channel(priced).withColumn("analysis_date", as_of)


def top_campaigns(rows: DataFrame, limit: int = 10) -> DataFrame:
    """Best return first; campaigns without spend come last."""
    paid = rows.filter(F.col("coupon_code") != ORGANIC_CODE)
    ordered = paid.orderBy(F.col("roi_percentage").desc_nulls_last(), "coupon_code", "channel")
    return ordered.limit(limit).select(
        "campaign_name", "coupon_code", "channel", "attributed_revenue", "actual_spend", "roi_percentage", "roas"
    )


def campaign_summary(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("coupon_code") != ORGANIC_CODE).agg(
        F.count(F.lit(1)).alias("total_campaigns"),
        numbers.money(F.sum("attributed_revenue")).alias("total_revenue"),
        numbers.money(F.sum("actual_spend")).alias("total_spend"),
        numbers.mean(F.col("roi_percentage").cast("decimal(30,6)")).alias("avg_roi"),
        numbers.mean(F.col("roas").cast("decimal(30,6)")).alias("avg_roas"),
    )
