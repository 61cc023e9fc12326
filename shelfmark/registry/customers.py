"""Customer, cohort, store and subscription queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.contracts import conform
from shelfmark.contracts.gold import GOLD
from shelfmark.functions import numbers
from shelfmark.plans import cohorts, customers, stores, subscriptions
from shelfmark.sources import shapes



def as_of():
    return shapes.day(shapes.ORDERS_AS_OF)


STAMPS = ("created_timestamp", "updated_timestamp")


def mart(df: DataFrame, name: str, *drop: str) -> DataFrame:
    """The mart under its contract, without load times."""
    return conform(df, GOLD[name]).drop(*STAMPS, *drop)


def bought(spark: SparkSession, folder: str) -> DataFrame:
    return customers.customer_products(shapes.transactions(spark, folder), shapes.transaction_items(spark, folder))


# --- basic aggregates -------------------------------------------------------

def agg_basic(spark, folder):
    return shapes.transactions(spark, folder).groupBy("customer_id").agg(
        F.count("transaction_id").alias("total_orders"),
        numbers.money(F.sum("total_amount")).alias("total_revenue"),
        numbers.mean(F.col("total_amount")).alias("avg_order_value"),
        F.min("transaction_date").alias("first_purchase_date"),
        F.max("transaction_date").alias("last_purchase_date"),
    )


def agg_count_distinct(spark, folder):
    return shapes.transactions(spark, folder).groupBy("channel").agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("store_id").alias("stores"),
        F.count_distinct("transaction_date").alias("days"),
    )


def agg_conditional_distinct(spark, folder):
    txns = shapes.transactions_flagged(spark, folder)
    first = F.col("is_first_purchase")
    return txns.groupBy("store_id").agg(
        *[F.count_distinct(F.when(F.col("channel") == channel, F.col("customer_id"))).alias(f"{name}_customers")
          for channel, name in (("online", "online"), ("mobile", "mobile"), ("in-store", "instore"))],
        F.count_distinct(F.when(first, F.col("customer_id"))).alias("new_customers"),
        F.count_distinct(F.when(~first, F.col("customer_id"))).alias("repeat_customers"),
    )


def agg_conditional(spark, folder):
    active = F.col("status") == "active"
    return shapes.subscriptions(spark, folder).groupBy("plan_id").agg(
        F.count_if(active).alias("active_subscribers"),
        numbers.money(F.sum(F.when(active, F.col("subscription_amount")).otherwise(0))).alias("mrr"),
        numbers.mean_when(active, F.col("lifetime_value")).alias("lifetime_value_avg"),
        numbers.mean_when(F.col("is_churned"), F.col("churn_risk_score")).alias("avg_churn_risk"),
    )


def agg_two_level(spark, folder):
    per_customer = shapes.transactions(spark, folder).groupBy("channel", "customer_id").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))
    return per_customer.groupBy("channel").agg(
        F.count("customer_id").alias("customers"), numbers.mean(F.col("orders")).alias("avg_orders"),
        F.max("orders").alias("max_orders"), numbers.mean(F.col("revenue")).alias("avg_revenue"),
        F.count_if(F.col("orders") > 1).alias("repeat_customers"),
    )


# --- customer profile -------------------------------------------------------

def base(spark, folder):
    return customers.base_metrics(shapes.transactions(spark, folder), as_of())


def customer_base_metrics(spark, folder):
    return base(spark, folder)


def channel_mix(spark, folder):
    return customers.channel_mix(shapes.transactions(spark, folder), as_of())


def customer_recent_windows(spark, folder):
    return customers.recent_windows(shapes.transactions(spark, folder), as_of())


def rfm_scores(spark, folder):
    return customers.rfm_scores(base(spark, folder)).select(
        "customer_id", "days_since_last_purchase", "total_orders", "total_revenue", "recency_score", "frequency_score",
        "monetary_score")


def rfm_segment(spark, folder):
    return customers.with_segment(customers.rfm_scores(base(spark, folder))).select(
        "customer_id", "recency_score", "frequency_score", "rfm_segment")


def churn_clv_heuristics(spark, folder):
    return customers.with_predictions(base(spark, folder)).select("customer_id", "clv_prediction", "churn_probability")


def lifetime_stage(spark, folder):
    return customers.with_predictions(base(spark, folder)).select(
        "customer_id", "total_orders", "days_since_last_purchase", "lifetime_stage")


def surrogate_keys(spark, folder):
    return customers.surrogate_keys(shapes.transactions(spark, folder).select("customer_id").distinct())


def customer_item_metrics(spark, folder):
    profile = customers.item_profile(bought(spark, folder), shapes.product_catalog(spark, folder), as_of())
    return profile.drop("most_purchased_category", "most_purchased_brand")


def premium_share(spark, folder):
    return customers.premium_share(bought(spark, folder), shapes.product_catalog(spark, folder), as_of())


def customer_returns(spark, folder):
    return customers.returns(bought(spark, folder))


def favorite_category_brand(spark, folder):
    return customers.favourites(bought(spark, folder), shapes.product_catalog(spark, folder), as_of())


def primary_channel(spark, folder):
    return customers.primary_channel(shapes.transactions(spark, folder), as_of())


def loyalty_balance(spark, folder):
    return customers.loyalty(shapes.transactions(spark, folder), as_of())


def customer_subscriptions(spark, folder):
    return customers.subscription_profile(shapes.subscriptions(spark, folder))


def customer_support(spark, folder):
    return customers.support_profile(shapes.customer_interactions(spark, folder))


def gold_customer_360(spark, folder):
    profile = customers.customer_360(
        shapes.transactions(spark, folder), shapes.transaction_items(spark, folder),
        shapes.product_catalog(spark, folder), shapes.subscriptions(spark, folder),
        shapes.customer_interactions(spark, folder), as_of(),
    )
    return mart(profile, "customer_360")


# --- cohorts ----------------------------------------------------------------

def months(spark, folder):
    return cohorts.active_months(shapes.transactions(spark, folder))


def cohort(spark, folder):
    return cohorts.cohort_analysis(shapes.transactions(spark, folder), shapes.subscriptions(spark, folder))


def cohort_assign(spark, folder):
    return cohorts.assign(shapes.transactions(spark, folder)).select(
        "transaction_id", "customer_id", "first_purchase_date", "cohort_month", cohorts.OFFSET)


def cohort_size(spark, folder):
    return cohorts.sizes(shapes.transactions(spark, folder))


def cohort_size_distribution(spark, folder):
    return cohorts.sizes(shapes.transactions(spark, folder)).orderBy("cohort_month").withColumnRenamed("cohort_size", "customers")


def cohort_retention(spark, folder):
    return cohorts.with_retention(cohorts.period_counts(months(spark, folder))).select(
        "cohort_month", cohorts.OFFSET, "cohort_size", "customers_active", "retention_rate", "churn_rate")


def repeat_customers(spark, folder):
    return cohorts.repeat_customers(shapes.transactions(spark, folder))


def cohort_cumulative(spark, folder):
    rows = cohorts.with_cumulative(cohorts.with_retention(cohorts.period_counts(months(spark, folder))))
    return rows.select(
        "cohort_month", cohorts.OFFSET, "cumulative_orders", "cumulative_cohort_revenue", "cumulative_retention_rate",
        "cumulative_churn_rate", "cumulative_avg_revenue_per_customer", "cumulative_avg_orders_per_customer")


def cohort_channel_mix(spark, folder):
    rows = cohorts.with_ratios(cohorts.period_counts(months(spark, folder)))
    return rows.select("cohort_month", cohorts.OFFSET, *[f"{name}_percentage" for name in cohorts.CHANNELS.values()])


def subscription_adoption(spark, folder):
    return cohorts.subscription_adoption(shapes.transactions(spark, folder), shapes.subscriptions(spark, folder))


def gold_cohort(spark, folder):
    return mart(cohort(spark, folder), "cohort_analysis")


def cohort_ltv_summary(spark, folder):
    return cohorts.ltv_summary(cohort(spark, folder))


def latest_cohort_curve(spark, folder):
    return cohorts.latest_curve(cohort(spark, folder))


# --- stores and subscriptions -----------------------------------------------

def store_rank(spark, folder):
    metrics = stores.store_metrics(shapes.transactions(spark, folder), shapes.stores(spark, folder))
    return stores.store_ranks(metrics).select("store_id", "store_region", "daily_revenue", "revenue_rank_in_region")


def gold_store_performance(spark, folder):
    return mart(stores.store_performance(shapes.transactions(spark, folder), shapes.stores(spark, folder)), "store_performance")


def store_snapshot(spark, folder):
    rows = stores.store_snapshot(shapes.transactions(spark, folder), shapes.stores(spark, folder), as_of())
    return mart(rows, "store_performance").drop("revenue_trend_7d", "revenue_growth_wow", "revenue_growth_yoy")


def store_daily_trend(spark, folder):
    return stores.store_daily(shapes.transactions(spark, folder), shapes.stores(spark, folder))


def plan_mrr_arr(spark, folder):
    return subscriptions.plan_revenue(shapes.subscriptions(spark, folder))


def plan_churn(spark, folder):
    return subscriptions.plan_churn(shapes.subscriptions(spark, folder))


def subscription_health_full(spark, folder):
    return subscriptions.subscription_health(shapes.subscriptions(spark, folder), as_of())


def gold_subscription_health(spark, folder):
    return mart(subscription_health_full(spark, folder), "subscription_health")


QUERIES = {
    f.__name__: f
    for f in (
        agg_basic, agg_count_distinct, agg_conditional_distinct, agg_conditional, agg_two_level, customer_base_metrics,
        channel_mix, customer_recent_windows, rfm_scores, rfm_segment, churn_clv_heuristics, lifetime_stage,
        surrogate_keys, customer_item_metrics, premium_share, customer_returns, favorite_category_brand, primary_channel,
        loyalty_balance, customer_subscriptions, customer_support, gold_customer_360, cohort_assign, cohort_size,
        cohort_size_distribution, cohort_retention, repeat_customers, cohort_cumulative, cohort_channel_mix,
        subscription_adoption, gold_cohort, cohort_ltv_summary, latest_cohort_curve, store_rank, gold_store_performance, store_snapshot,
        store_daily_trend, plan_mrr_arr, plan_churn, subscription_health_full, gold_subscription_health,
    )
}
