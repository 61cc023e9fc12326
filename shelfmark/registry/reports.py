"""Data-quality and summary reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import quality, silver
from shelfmark.plans import reports
from shelfmark.registry.layers import RUN_TIME, raw_tables
from shelfmark.sources import shapes


def accounts(spark, folder):
    """Customers with an exact balance, for the plain table queries."""
    return shapes.table(spark, folder, "customer").withColumn("balance", F.col("c_acctbal").cast("decimal(12,2)"))


def dq_null_keys(spark, folder):
    """Key checks on all silver tables, from feeds in which some codes are unreadable."""
    raw = raw_tables(spark, folder)
    run, day = F.lit(RUN_TIME), shapes.day(shapes.ORDERS_AS_OF)

    def broken(name, **steps):
        offset = F.col("_record_offset")
        return raw[name].withColumns({c: F.when(offset % step == 0, F.lit("n/a")).otherwise(F.col(c)) for c, step in steps.items()})

    return quality.null_keys({
        "transactions": (
            silver.transactions_from_raw(broken("transactions_raw", transaction_id=97, customer_id=89), run), ["transaction_id", "customer_id"]),
        "transaction_items": (
            silver.transaction_items_from_raw(raw["transaction_items_raw"], run),
            ["transaction_item_id", "transaction_id", "product_id"]),
        "subscriptions": (
            silver.subscriptions_from_raw(broken("subscriptions_raw", customer_id=83), day, run), ["subscription_id", "customer_id"]),
        "product_catalog": (
            silver.product_catalog_from_raw(broken("product_catalog_raw", supplier_id=5), day, run), ["product_id", "supplier_id"]),
        "inventory_snapshots": (
            silver.inventory_from_raw(broken("inventory_snapshots_raw", warehouse_id=4), run), ["snapshot_id", "product_id", "warehouse_id"]),
        "customer_interactions": (
            silver.interactions_from_raw(broken("customer_interactions_raw", agent_id=10), run), ["interaction_id", "customer_id", "agent_id"]),
    })


def row_reconciliation(spark, folder):
    raw, run, day = raw_tables(spark, folder), F.lit(RUN_TIME), shapes.day(shapes.ORDERS_AS_OF)
    return quality.reconciliation({
        "transactions": (raw["transactions_raw"], silver.transactions_from_raw(raw["transactions_raw"], run)),
        "transaction_items": (
            raw["transaction_items_raw"], silver.transaction_items_from_raw(raw["transaction_items_raw"], run)),
        "subscriptions": (raw["subscriptions_raw"], silver.subscriptions_from_raw(raw["subscriptions_raw"], day, run)),
    })


def partition_distribution(spark, folder):
    return quality.distribution(shapes.transactions(spark, folder), "transaction_year", "transaction_month")


def subscription_summary(spark, folder):
    return reports.subscription_summary(shapes.subscriptions(spark, folder))


def status_distribution(spark, folder):
    return quality.distribution(shapes.subscriptions(spark, folder), "status")


def churn_split(spark, folder):
    return reports.churn_split(shapes.subscriptions(spark, folder))


def catalog_summary(spark, folder):
    return reports.catalog_summary(shapes.product_catalog(spark, folder))


def lifecycle_distribution(spark, folder):
    return quality.distribution(shapes.product_catalog(spark, folder), "lifecycle_stage")


def category_distribution(spark, folder):
    return quality.distribution(shapes.product_catalog(spark, folder), "category_level1")


def price_tier_distribution(spark, folder):
    return quality.distribution(shapes.product_catalog(spark, folder), "price_tier")


def inventory_summary(spark, folder):
    return reports.inventory_summary(shapes.inventory_snapshots(spark, folder))


def stock_status_share(spark, folder):
    return reports.stock_status_share(shapes.inventory_snapshots(spark, folder))


def warehouse_summary(spark, folder):
    return reports.warehouse_summary(shapes.inventory_snapshots(spark, folder))


def restock_attention(spark, folder):
    return reports.restock_attention(shapes.inventory_snapshots(spark, folder))


def interaction_summary(spark, folder):
    return reports.interaction_summary(shapes.customer_interactions(spark, folder))


def interaction_by_type(spark, folder):
    return reports.interactions_by_type(shapes.customer_interactions(spark, folder))


def interaction_by_channel(spark, folder):
    return reports.interactions_by_channel(shapes.customer_interactions(spark, folder))


def interaction_by_category(spark, folder):
    return reports.interactions_by_category(shapes.customer_interactions(spark, folder))


def sentiment_buckets(spark, folder):
    return reports.sentiment_buckets(shapes.customer_interactions(spark, folder))


def escalated_recent(spark, folder):
    return reports.escalated_recent(shapes.customer_interactions(spark, folder))


# --- plain table queries ----------------------------------------------------

def filter_equality(spark, folder):
    return accounts(spark, folder).filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name", "balance")


def group_stats(spark, folder):
    return reports.group_stats(accounts(spark, folder), "c_mktsegment", "balance")


def group_counts(spark, folder):
    return quality.distribution(accounts(spark, folder), "c_nationkey")


def topk_simple(spark, folder):
    best = accounts(spark, folder).orderBy(F.col("balance").desc(), "c_custkey").limit(5)
    return best.select("c_name", "c_mktsegment", "balance", "c_nationkey")


QUERIES = {
    f.__name__: f
    for f in (
        dq_null_keys, row_reconciliation, partition_distribution, subscription_summary, status_distribution, churn_split,
        catalog_summary, lifecycle_distribution, category_distribution, price_tier_distribution, inventory_summary,
        stock_status_share, warehouse_summary, restock_attention, interaction_summary, interaction_by_type,
        interaction_by_channel, interaction_by_category, sentiment_buckets, escalated_recent, filter_equality, group_stats,
        group_counts, topk_simple,
    )
}
