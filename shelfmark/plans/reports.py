"""Summaries of the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.functions import ladders, numbers

TOP = 10


def item_totals(items: DataFrame) -> DataFrame:
    total = lambda name: numbers.money(F.sum(name))
    return items.agg(
        total("line_subtotal").alias("total_subtotal"), total("line_discount").alias("total_discount"),
        total("line_tax").alias("total_tax"), total("line_total").alias("total_revenue"),
        total("line_cost").alias("total_cost"), total("line_profit").alias("total_profit"),
        numbers.mean(F.col("line_margin_percentage")).alias("avg_margin_pct"),
    )


def subscription_summary(subs: DataFrame) -> DataFrame:
    return subs.agg(
        F.count(F.lit(1)).alias("total_subscriptions"),
        F.count_if("is_churned").alias("churned_count"),
        numbers.mean(F.col("subscription_amount")).alias("avg_subscription_amount"),
        numbers.money(F.sum("lifetime_value")).alias("total_lifetime_value"),
        numbers.mean(F.col("churn_risk_score")).alias("avg_churn_risk"),
        numbers.mean(F.col("subscription_duration_days")).alias("avg_duration_days"),
    )


def churn_split(subs: DataFrame) -> DataFrame:
    return subs.groupBy("is_churned").agg(
        F.count(F.lit(1)).alias("row_count"), numbers.mean(F.col("churn_risk_score")).alias("avg_churn_risk")
    )


def catalog_summary(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count_if("is_active").alias("active_products"),
        numbers.mean(F.col("list_price")).alias("avg_list_price"),
        numbers.mean(F.col("margin_percentage")).alias("avg_margin_pct"),
        numbers.mean(F.col("product_age_days")).alias("avg_age_days"),
    )


def inventory_summary(inventory: DataFrame) -> DataFrame:
    status = F.col("stock_status")
    return inventory.agg(
        F.count(F.lit(1)).alias("total_snapshots"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("warehouse_id").alias("unique_warehouses"),
        *[numbers.whole(F.sum(f"quantity_{name}")).alias(f"total_qty_{name}") for name in ("on_hand", "reserved", "available")],
        numbers.mean(F.col("days_of_supply")).alias("avg_days_of_supply"),
        F.count_if("is_stockout").alias("stockout_count"),
        *[F.count_if(status == name).alias(f"{name}_count") for name in ("low_stock", "in_stock", "overstock")],
    )


def stock_status_share(inventory: DataFrame) -> DataFrame:
    """Rows per stock status and their share; the window runs over the four status rows."""
    counted = inventory.groupBy("stock_status").agg(F.count(F.lit(1)).alias("row_count"))
    everything = F.sum("row_count").over(Window.partitionBy())
    return counted.withColumn("percentage", numbers.percent(F.col("row_count"), everything))


def warehouse_summary(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("warehouse_id").agg(
        F.count(F.lit(1)).alias("product_count"),
        numbers.whole(F.sum("quantity_available")).alias("total_available"),
        F.count_if("is_stockout").alias("stockout_count"),
        numbers.mean(F.col("days_of_supply")).alias("avg_days_supply"),
    )


def restock_attention(inventory: DataFrame, limit: int = TOP) -> DataFrame:
    """The snapshots with the least available stock among low and empty ones."""
    columns = ["product_id", "warehouse_id", "quantity_available", "reorder_point", "stock_status", "is_stockout"]
    needy = inventory.filter(F.col("stock_status").isin("low_stock", "out_of_stock"))
    order = ["quantity_available", "product_id", "warehouse_id", "reorder_point", "snapshot_date", "snapshot_id"]
    return needy.orderBy(*order).limit(limit).select(*columns)


def interaction_summary(talks: DataFrame) -> DataFrame:
    return talks.agg(
        F.count(F.lit(1)).alias("total_interactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("agent_id").alias("unique_agents"),
        F.count_if(F.col("agent_id").isNull()).alias("null_agent_ids"),
        F.count_if("is_resolved").alias("resolved"),
        F.count_if("is_escalated").alias("escalated"),
        numbers.mean(F.col("sentiment_score")).alias("avg_sentiment"),
        numbers.mean(F.col("resolution_time_minutes")).alias("avg_resolution_mins"),
        numbers.mean(F.col("satisfaction_rating")).alias("avg_satisfaction"),
    )


def interactions_by_type(talks: DataFrame) -> DataFrame:
    return talks.groupBy("interaction_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        numbers.mean(F.col("sentiment_score")).alias("avg_sentiment"),
        numbers.mean(F.col("resolution_time_minutes")).alias("avg_resolution_time"),
    )


def interactions_by_channel(talks: DataFrame) -> DataFrame:
    return talks.groupBy("channel").agg(
        F.count(F.lit(1)).alias("row_count"),
        numbers.mean(F.col("satisfaction_rating")).alias("avg_satisfaction"),
        F.count_if("is_escalated").alias("escalations"),
    )


def interactions_by_category(talks: DataFrame, limit: int = TOP) -> DataFrame:
    counted = talks.groupBy("category", "subcategory").agg(
        F.count(F.lit(1)).alias("row_count"),
        numbers.mean(F.col("sentiment_score")).alias("avg_sentiment"),
        F.count_if("is_resolved").alias("resolved_count"),
    )
    return counted.orderBy(F.col("row_count").desc(), "category", "subcategory").limit(limit)


def sentiment_buckets(talks: DataFrame) -> DataFrame:
    return talks.groupBy(ladders.sentiment_bucket(F.col("sentiment_score")).alias("sentiment_category")).agg(
        F.count(F.lit(1)).alias("row_count"),
        numbers.mean(F.col("satisfaction_rating")).alias("avg_satisfaction"),
        numbers.mean(F.col("resolution_time_minutes")).alias("avg_resolution_time"),
    )


def escalated_recent(talks: DataFrame, limit: int = TOP) -> DataFrame:
    return talks.filter("is_escalated").orderBy(F.col("interaction_date").desc(), F.col("interaction_id").desc()).limit(
        limit
    ).select("interaction_id", "customer_id", "interaction_type", "category", "sentiment_score", "is_resolved")


def group_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("row_count"), numbers.mean(F.col(value)).alias("avg_value"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
    )
