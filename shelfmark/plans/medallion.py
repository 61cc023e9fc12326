"""The three layers end to end: feeds to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.contracts.bronze import BRONZE
from shelfmark.contracts.gold import GOLD
from shelfmark.contracts.silver import SILVER
from shelfmark.operators import silver as typing
from shelfmark.operators.quality import require_nonempty
from shelfmark.plans import attribution, baskets, campaigns, categories, cohorts, customers, products, stores, subscriptions
from shelfmark.sources.loading import load_feeds
from shelfmark.sources.readers import read_layer
from shelfmark.sources.staging import read_published
from shelfmark.sources.writers import write_table


# The feeds without which no mart can be computed.
REQUIRED = ("transactions_raw", "transaction_items_raw", "subscriptions_raw", "customer_interactions_raw", "product_catalog_raw",
            "inventory_snapshots_raw")


def bronze(spark: SparkSession, files: dict[str, str], folder: str) -> DataFrame:
    """Loads the feeds and returns the load report; feeds that pass their audit are published."""
    return load_feeds(spark, files, folder)


def published(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The current version of every feed."""
    return {name: read_published(spark, folder, target) for name, target in BRONZE.items()}


def run(spark: SparkSession, files: dict[str, str], store_dim: DataFrame, folder: str, as_of: str, run_ts: str) -> DataFrame:
    """All three layers below a folder. Stops at the gate, before silver, when a required feed has no published rows."""
    report = bronze(spark, files, f"{folder}/bronze")
    raw = published(spark, f"{folder}/bronze")
    require_nonempty(spark, {name: raw[name] for name in REQUIRED})
    write_silver(silver(raw, as_of, run_ts), f"{folder}/silver")
    typed = {name: read_layer(spark, f"{folder}/silver/{name}", target) for name, target in SILVER.items()}
    write_gold(gold(typed, store_dim, as_of), f"{folder}/gold", run_ts)
    return report


def silver(raw: dict[str, DataFrame], as_of: str, run_ts: str) -> dict[str, DataFrame]:
    """Silver frames from raw feeds."""
    day, moment = F.lit(as_of).cast("date"), F.lit(run_ts).cast("timestamp")
    items = typing.transaction_items_from_raw(raw["transaction_items_raw"], moment)
    return {
        "transactions": typing.transactions_from_raw(raw["transactions_raw"], moment, items),
        "transaction_items": items,
        "subscriptions": typing.subscriptions_from_raw(raw["subscriptions_raw"], day, moment),
        "customer_interactions": typing.interactions_from_raw(raw["customer_interactions_raw"], moment),
        "product_catalog": typing.product_catalog_from_raw(raw["product_catalog_raw"], day, moment),
        "inventory_snapshots": typing.inventory_from_raw(raw["inventory_snapshots_raw"], moment),
        "marketing_campaigns": typing.campaigns_from_raw(raw["marketing_campaigns_raw"], moment),
        "campaign_events": typing.campaign_events_from_raw(raw["campaign_events_raw"], moment),
    }


def gold(tables: dict[str, DataFrame], store_dim: DataFrame, as_of: str) -> dict[str, DataFrame]:
    """Gold frames from silver frames."""
    day = F.lit(as_of).cast("date")
    txns, items, catalog = tables["transactions"], tables["transaction_items"], tables["product_catalog"]
    subs, talks = tables["subscriptions"], tables["customer_interactions"]
    touches = attribution.union_touchpoints(txns, talks)
    return {
        "customer_360": customers.customer_360(txns, items, catalog, subs, talks, day),
        "product_performance": products.product_performance(items, catalog, txns, tables["inventory_snapshots"], day),
        "store_performance": stores.store_performance(txns, store_dim),
        "subscription_health": subscriptions.subscription_health(subs, day),
        "category_brand_performance": categories.category_brand_performance(items, catalog, txns, day),
        "campaign_roi_analysis": campaigns.campaign_roi(
            txns, tables["marketing_campaigns"], tables["campaign_events"], day
        ),
        "cohort_analysis": cohorts.cohort_analysis(txns, subs),
        "basket_analysis": baskets.basket_analysis(txns, items, catalog, day),
        "channel_attribution": attribution.channel_attribution(touches),
    }


def write_silver(tables: dict[str, DataFrame], folder: str) -> None:
    months = tables["transactions"].select("transaction_id", F.trunc("transaction_date", "MM").alias("order_month"))
    for name, df in tables.items():
        if name == "transaction_items":
            df = df.join(months, "transaction_id", "left")
        write_table(df, f"{folder}/{name}", SILVER[name])


def write_gold(marts: dict[str, DataFrame], folder: str, run_ts: str) -> None:
    stamp = F.lit(run_ts).cast("timestamp")
    for name, df in marts.items():
        done = df.withColumns({"created_timestamp": stamp, "updated_timestamp": stamp})
        write_table(done, f"{folder}/{name}", GOLD[name])
