"""First-match business ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days covered by one payment of each billing frequency.
PAYMENT_DAYS = {"monthly": 30, "quarterly": 90, "annual": 365, "annually": 365}

# Channels of a sale.
SALES_CHANNELS = ("online", "mobile", "in-store", "marketplace")


def price_tier(price: Column) -> Column:
    return (
        F.when(price < 50, "budget").when(price < 200, "mid-range").when(price < 500, "premium")
        .when(price.isNotNull(), "luxury")
    )


def lifecycle_stage(is_active: Column, age_days: Column) -> Column:
    return (
        F.when(~is_active, "discontinued").when(age_days < 90, "introduction")
        .when(age_days < 365, "growth").when(age_days < 1095, "maturity").otherwise("decline")
    )


def payment_count(frequency: Column, days: Column) -> Column:
    """Whole billing periods in ``days``; at least one once a day has passed."""
    periods = F.lit(0)
    for name, length in reversed(PAYMENT_DAYS.items()):
        periods = F.when(frequency == name, F.floor(days / length)).otherwise(periods)
    return F.when((days > 0) & (periods < 1), 1).otherwise(periods).cast("int")


def churn_risk(is_churned: Column, status: Column, auto_renewal: Column, days_to_end: Column, payments: Column) -> Column:
    at_end = F.coalesce(days_to_end, F.lit(999)) < 30
    return (
        F.when(is_churned, 1.0).when(status.isin("pending_cancellation", "payment_failed"), 0.8)
        .when(~auto_renewal & at_end, 0.7).when(~auto_renewal, 0.5).when(payments < 3, 0.4).otherwise(0.2)
    ).cast("decimal(3,2)")


def stock_status(available: Column, reorder_point: Column) -> Column:
    return (
        F.when(available <= 0, "out_of_stock").when(available < reorder_point, "low_stock")
        .when(available > reorder_point * 3, "overstock").otherwise("in_stock")
    )


def sentiment_bucket(score: Column) -> Column:
    return (
        F.when(score.isNull(), "Unknown").when(score >= 0.5, "Positive").when(score >= 0, "Neutral")
        .otherwise("Negative")
    )


def rfm_segment(recency: Column, frequency: Column, idle_days: Column) -> Column:
    return (
        F.when((recency >= 4) & (frequency >= 4), "Champions")
        .when((recency >= 3) & (frequency >= 3), "Loyal Customers")
        .when(idle_days > 180, "At Risk").otherwise("Regular Customers")
    )


def churn_probability(idle_days: Column) -> Column:
    return F.when(idle_days > 180, 0.8).when(idle_days > 90, 0.5).otherwise(0.2).cast("decimal(3,2)")


def lifetime_stage(orders: Column, idle_days: Column) -> Column:
    return (
        F.when(orders == 1, "new").when(idle_days > 365, "churned").when(idle_days > 180, "at_risk")
        .otherwise("active")
    )


def campaign_type(is_organic: Column, channel: Column) -> Column:
    return (
        F.when(is_organic, "organic").when(channel == "online", "digital")
        .when(channel == "mobile", "mobile_app").otherwise("offline")
    )


def trend(recent: Column, earlier: Column, band: float = 0.10) -> Column:
    """up / down / stable: ``recent`` against ``earlier`` with a tolerance band."""
    return F.when(recent > earlier * (1 + band), "up").when(recent < earlier * (1 - band), "down").otherwise("stable")
