"""Subscription health per plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import numbers
from shelfmark.operators.firsts import top_value
from shelfmark.plans.customers import monthly_amount

# Tenure bands in months, and cancellation reasons that are not the customer's choice.
TENURE_BANDS = {"0_3": (0, 3), "3_6": (3, 6), "6_12": (6, 12), "12plus": (12, None)}
INVOLUNTARY_REASONS = ("payment_failed", "card_expired")
DAYS_PER_MONTH = 30


def plan_revenue(subs: DataFrame) -> DataFrame:
    """Active subscribers, monthly and yearly recurring revenue, value of active subscriptions.

    As in the declared metric, the monthly figure is the plain sum of active
    amounts; ``mrr_normalised`` spreads quarterly and annual amounts over their
    months.
    """
    active = F.col("status") == "active"
    amount = F.col("subscription_amount")
    per_month = monthly_amount(amount, F.col("billing_frequency"))
    zero = F.lit(0).cast("decimal(10,2)")
    return subs.groupBy("plan_id").agg(
        F.count_if(active).alias("active_subscribers"),
        numbers.money(F.sum(F.when(active, amount).otherwise(zero))).alias("mrr"),
        F.coalesce(F.sum(F.when(active, per_month)), F.lit(0)).cast("decimal(18,2)").alias("mrr_normalised"),
        numbers.mean_when(active, F.col("lifetime_value")).alias("lifetime_value_avg"),
    ).withColumn("arr", (F.col("mrr") * 12).cast("decimal(20,2)"))


def plan_churn(subs: DataFrame) -> DataFrame:
    """Churned subscriptions as a share of all, plus the mean risk score of the others."""
    churned = F.col("is_churned")
    return subs.groupBy("plan_id").agg(
        F.count(F.lit(1)).alias("subscribers"),
        F.count_if(churned).alias("churned_subscribers"),
        numbers.percent(F.count_if(churned), F.count(F.lit(1))).alias("churn_rate"),
        numbers.mean_when(~churned, F.col("churn_risk_score")).alias("avg_open_risk"),
    )


def subscription_health(subs: DataFrame, as_of: Column) -> DataFrame:
    """Everything the plan report declares that dates, states and amounts can tell."""
    start, gone = F.col("start_date"), F.coalesce(F.col("cancellation_date"), F.when(F.col("is_churned"), F.col("end_date")))
    status, churned = F.col("status"), F.col("is_churned")
    amount, active = F.col("subscription_amount"), F.col("status") == "active"
    month = F.trunc(as_of, "MM")
    before = F.add_months(month, -1)
    zero = F.lit(0).cast("decimal(10,2)")
    this_month = lambda day: (day >= month) & (day <= as_of)
    open_at = lambda day: (start < day) & (gone.isNull() | (gone >= day))
    tenure = F.floor(F.date_diff(F.when(churned, gone).otherwise(as_of), start) / DAYS_PER_MONTH)
    kept_for = lambda days: F.date_diff(F.when(churned, gone).otherwise(as_of), start) >= days
    old_enough = lambda days: F.date_diff(as_of, start) >= days

    def retention(days: int) -> Column:
        return numbers.percent(F.count_if(old_enough(days) & kept_for(days)), F.count_if(old_enough(days)))

    def band(low: int, high: int | None) -> Column:
        inside = tenure >= low if high is None else (tenure >= low) & (tenure < high)
        return numbers.percent(F.count_if(inside & ~churned), F.count_if(inside))

    sum_when = lambda condition, value=amount: F.coalesce(
        F.sum(F.when(condition, value)), zero
    ).cast("decimal(18,2)")
    involuntary = F.col("cancellation_reason").isin(*INVOLUNTARY_REASONS)
    flags = subs.withColumns(
        {
            "_opened": F.coalesce(this_month(start), F.lit(False)),
            "_left": F.coalesce(this_month(gone), F.lit(False)),
            "_at_start": F.coalesce(open_at(month), F.lit(False)),
            "_at_previous": F.coalesce(open_at(before), F.lit(False)),
            "_left_year": F.coalesce((gone > F.add_months(as_of, -12)) & (gone <= as_of), F.lit(False)),
            "_open_year_ago": F.coalesce(open_at(F.add_months(as_of, -12)), F.lit(False)),
        }
    )
    per_plan = flags.groupBy("plan_id").agg(
        F.count_if(active).alias("active_subscribers"),
        F.count_if(F.col("_opened")).alias("new_subscribers_mtd"),
        F.count_if(F.col("_left")).alias("cancelled_subscribers_mtd"),
        F.count_if(status == "paused").alias("paused_subscribers"),
        sum_when(active).alias("mrr"),
        numbers.mean_when(active, amount).alias("avg_revenue_per_subscriber"),
        numbers.mean_when(active, F.col("lifetime_value")).alias("lifetime_value_avg"),
        numbers.percent(F.count_if(F.col("_left") & F.col("_at_start")), F.count_if(F.col("_at_start")))
        .alias("churn_rate_monthly"),
        numbers.percent(F.count_if(F.col("_left_year") & F.col("_open_year_ago")), F.count_if(F.col("_open_year_ago")))
        .alias("churn_rate_annual"),
        sum_when(F.col("_left") & F.col("_at_start")).alias("_lost_amount"),
        sum_when(F.col("_opened")).alias("_new_amount"),
        sum_when(F.col("_at_start")).alias("_start_amount"),
        sum_when(F.col("_at_previous")).alias("_previous_amount"),
        F.count_if(F.col("_at_start")).alias("_at_start_n"),
        F.count_if(F.col("_at_previous")).alias("_at_previous_n"),
        *[retention(days).alias(f"retention_rate_{days}d") for days in (30, 90, 365)],
        *[band(*limits).alias(f"cohort_{name}_months_retention") for name, limits in TENURE_BANDS.items()],
        numbers.mean(F.col("subscription_duration_days")).alias("avg_subscription_duration_days"),
        numbers.mean_when(churned, F.col("total_payments_made")).alias("avg_payments_before_churn"),
        numbers.mean_when(F.col("cancellation_date").isNotNull(), F.date_diff("cancellation_date", "start_date"))
        .alias("avg_days_to_cancel"),
        numbers.percent(F.count_if(churned & ~F.coalesce(involuntary, F.lit(False))), F.count(F.lit(1)))
        .alias("voluntary_churn_rate"),
        numbers.percent(F.count_if(churned & F.coalesce(involuntary, F.lit(False))), F.count(F.lit(1)))
        .alias("involuntary_churn_rate"),
    )
    reasons = top_value(
        subs.filter("cancellation_reason is not null").select("plan_id", "cancellation_reason", F.lit(1).alias("n")),
        "plan_id", "cancellation_reason", "n", "top_cancellation_reason",
    )
    result = per_plan.join(reasons, "plan_id", "left")
    return result.withColumns(
        {
            "analysis_date": as_of,
            "plan_name": F.col("plan_id").cast("string"),
            "net_subscriber_change": F.col("new_subscribers_mtd") - F.col("cancelled_subscribers_mtd"),
            "arr": (F.col("mrr") * 12).cast("decimal(20,2)"),
            "revenue_churn_rate": numbers.percent(F.col("_lost_amount"), F.col("_start_amount")),
            "subscriber_growth_rate": numbers.growth(F.col("_at_start_n"), F.col("_at_previous_n")),
            "mrr_growth_rate": numbers.growth(F.col("_start_amount"), F.col("_previous_amount")),
            "quick_ratio": numbers.ratio(F.col("_new_amount"), F.col("_lost_amount")),
        }
    ).drop("_lost_amount", "_new_amount", "_start_amount", "_previous_amount", "_at_start_n", "_at_previous_n")
