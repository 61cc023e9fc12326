"""Cohorts by month of first purchase.

Everything is derived from one frame with a row per customer and active month.
A customer has at most one row per calendar month there, so the windows over a
customer stay short whatever the number of orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.functions import numbers
from shelfmark.functions.calendar import month_start, months_apart

EPOCH = "1970-01-01"
OFFSET = "months_since_first_purchase"
CHANNELS = {"online": "online", "mobile": "mobile", "in-store": "instore", "marketplace": "marketplace"}


def first_purchases(txns: DataFrame) -> DataFrame:
    """First purchase day and cohort month per customer."""
    first = txns.groupBy("customer_id").agg(F.min("transaction_date").alias("first_purchase_date"))
    return first.withColumn("cohort_month", month_start(F.col("first_purchase_date")))


def assign(txns: DataFrame) -> DataFrame:
    """Each transaction with its customer's cohort and the month offset.

    The joined side has one row per customer; adaptive execution splits the
    transactions of a heavy customer.
    """
    joined = txns.join(first_purchases(txns), "customer_id", "left")
    return joined.withColumn(OFFSET, months_apart(F.col("transaction_date"), F.col("cohort_month")))


def sizes(txns: DataFrame) -> DataFrame:
    """Customers per cohort month."""
    return first_purchases(txns).groupBy("cohort_month").agg(F.count("customer_id").alias("cohort_size"))


def active_months(txns: DataFrame) -> DataFrame:
    """Customer by active month: orders, revenue, channels used, days between orders."""
    day_number = F.date_diff(F.col("transaction_date"), F.lit(EPOCH).cast("date"))
    monthly = txns.filter("transaction_date is not null").groupBy(
        "customer_id", month_start(F.col("transaction_date")).alias("month")
    ).agg(
        F.count("transaction_id").alias("orders"),
        F.sum("total_amount").alias("revenue"),
        F.min(day_number).alias("first_day"),
        F.max(day_number).alias("last_day"),
        F.sum(day_number.cast("bigint")).alias("day_sum"),
        *[F.max(F.coalesce(F.col("channel") == channel, F.lit(False))).alias(f"used_{name}") for channel, name in CHANNELS.items()],
    )
    whole = Window.partitionBy("customer_id")
    # Gaps telescope: inside a month they add up to last - first day, plus the step from the month before.
    previous = F.lag("last_day").over(whole.orderBy("month"))
    return monthly.withColumns(
        {
            "cohort_month": F.min("month").over(whole),
            "_first": F.min("first_day").over(whole),
            "gap_days": F.col("last_day") - F.coalesce(previous, F.col("first_day")),
            "gaps": F.col("orders") - F.when(previous.isNull(), 1).otherwise(0),
        }
    ).withColumns(
        {
            OFFSET: months_apart(F.col("month"), F.col("cohort_month")),
            "days_since_first": F.col("day_sum") - F.col("orders") * F.col("_first"),
        }
    )


def period_counts(months: DataFrame) -> DataFrame:
    """Cohort by month offset: plain sums, no distinct counting left to do."""
    return months.groupBy("cohort_month", OFFSET).agg(
        F.count("customer_id").alias("customers_active"),
        numbers.whole(F.sum("orders")).alias("total_orders"),
        numbers.money(F.sum("revenue")).alias("cohort_revenue"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers_count"),
        *[F.count_if(f"used_{name}").alias(f"{name}_customers") for name in CHANNELS.values()],
        numbers.ratio(F.sum("gap_days"), F.sum("gaps")).alias("avg_days_between_purchases"),
        numbers.ratio(F.sum("days_since_first"), F.sum("orders")).alias("avg_days_since_first"),
    )


def with_retention(counts: DataFrame) -> DataFrame:
    """Cohort size, retention and churn; a partition is one cohort's offsets."""
    cohort = Window.partitionBy("cohort_month")
    size = F.max(F.when(F.col(OFFSET) == 0, F.col("customers_active"))).over(cohort)
    kept = numbers.percent(F.col("customers_active"), F.col("cohort_size"))
    return counts.withColumn("cohort_size", size).withColumns(
        {"retention_rate": kept, "churn_rate": F.round(100 - kept, 6)}
    )


def with_ratios(counts: DataFrame) -> DataFrame:
    active = F.col("customers_active")
    return counts.withColumns(
        {
            "avg_revenue_per_customer": numbers.ratio(F.col("cohort_revenue"), active),
            "avg_orders_per_customer": numbers.ratio(F.col("total_orders"), active),
            "avg_purchase_frequency": numbers.ratio(F.col("total_orders"), active),
            "repeat_purchase_rate": numbers.percent(F.col("repeat_customers_count"), active),
            **{
                f"{name}_percentage": numbers.percent(F.col(f"{name}_customers"), active)
                for name in CHANNELS.values()
            },
        }
    )


def with_cumulative(counts: DataFrame) -> DataFrame:
    """Running orders and revenue, and the running mean of retention."""
    so_far = Window.partitionBy("cohort_month").orderBy(OFFSET).rowsBetween(Window.unboundedPreceding, 0)
    running = lambda name: F.sum(name).over(so_far)
    size = F.col("cohort_size")
    mean_kept = numbers.percent(running("customers_active"), size * F.count(F.lit(1)).over(so_far))
    return counts.withColumns(
        {
            "cumulative_orders": numbers.whole(running("total_orders")),
            "cumulative_cohort_revenue": numbers.money(running("cohort_revenue")),
            "cumulative_retention_rate": mean_kept,
            "cumulative_churn_rate": F.round(100 - mean_kept, 6),
        }
    ).withColumns(
        {
            "cumulative_avg_revenue_per_customer": numbers.ratio(F.col("cumulative_cohort_revenue"), size),
            "cumulative_avg_orders_per_customer": numbers.ratio(F.col("cumulative_orders"), size),
        }
    )


def subscription_adoption(txns: DataFrame, subs: DataFrame) -> DataFrame:
    """Subscribers and their mean amount by cohort and month offset of the subscription start."""
    started = subs.groupBy("customer_id", month_start(F.col("start_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("subs"), F.sum("subscription_amount").alias("amount")
    )
    placed = started.join(first_purchases(txns).select("customer_id", "cohort_month"), "customer_id")
    return placed.withColumn(OFFSET, months_apart(F.col("month"), F.col("cohort_month"))).groupBy(
        "cohort_month", OFFSET
    ).agg(
        F.count("customer_id").alias("subscribers"),
        numbers.ratio(F.sum("amount"), F.sum("subs")).alias("avg_subscription_value"),
    )


def cohort_analysis(txns: DataFrame, subs: DataFrame) -> DataFrame:
    """One row per cohort and month offset. ``subs`` may be an empty frame."""
    rows = with_cumulative(with_ratios(with_retention(period_counts(active_months(txns)))))
    adopted = rows.join(subscription_adoption(txns, subs), ["cohort_month", OFFSET], "left")
    subscribers = F.coalesce(F.col("subscribers"), F.lit(0))
    return adopted.withColumns(
        {
            "subscription_adoption_rate": numbers.percent(subscribers, F.col("customers_active")),
            "avg_subscription_value": F.coalesce(F.col("avg_subscription_value"), F.lit(0.0)),
        }
    ).drop("subscribers")


def latest_curve(rows: DataFrame, months: int = 12) -> DataFrame:
    """The first ``months`` offsets of the most recent cohort."""
    newest = rows.agg(F.max("cohort_month").alias("newest")).scalar()
    picked = rows.filter(F.col("cohort_month") == newest).select(
        "cohort_month", OFFSET, "cohort_size", "customers_active", "retention_rate", "cumulative_avg_revenue_per_customer"
    )
    return picked.orderBy(OFFSET).limit(months)


def ltv_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cohort_month").agg(
        F.max("cohort_size").alias("cohort_size"),
        F.max("cumulative_avg_revenue_per_customer").alias("max_ltv"),
        F.max("cumulative_orders").alias("total_orders"),
    ).orderBy("cohort_month")


def repeat_customers(txns: DataFrame) -> DataFrame:
    """Customers with more than one order in a month, per cohort and offset."""
    repeated = active_months(txns).filter(F.col("orders") > 1)
    return repeated.groupBy("cohort_month", OFFSET).agg(F.count("customer_id").alias("repeat_customers_count"))
