"""Sources, sinks, silver transforms and their single rules."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.contracts import conform
from shelfmark.contracts import silver as silver_contracts
from shelfmark.contracts.bronze import BRONZE
from shelfmark.functions import calendar, ladders, text
from shelfmark.operators import firsts, history, quality, silver
from shelfmark.plans import cohorts, medallion
from shelfmark.sources import readers, shapes, staging, writers
from shelfmark.session import scratch, side_by_side
from shelfmark.sources.loading import load_feeds

RUN_TIME = "2001-08-02 06:00:00"
TIME_TEXT = "yyyy-MM-dd HH:mm:ss"

# Rows of one file of a feed: what one task reads of such files is sorted in memory.
FEED_ROWS = 250_000


def as_text(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps as text, so that results do not depend on the session's time zone."""
    return df.withColumns({name: F.date_format(name, TIME_TEXT) for name in names})


def write_feed_csv(df: DataFrame, path: str) -> str:
    stamped = df.withColumn("_ingestion_timestamp", F.date_format("_ingestion_timestamp", TIME_TEXT))
    stamped.write.csv(path, sep="|", header=True, quote='"', escape='"')
    return path


def bronze_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = write_feed_csv(shapes.raw_transactions(spark, folder), scratch(spark, "csv"))
    return as_text(readers.read_feed(spark, path, "transactions_raw"), "_ingestion_timestamp").select(BRONZE["transactions_raw"].columns)


RAW = {
    "transactions_raw": shapes.raw_transactions, "transaction_items_raw": shapes.raw_transaction_items,
    "subscriptions_raw": shapes.raw_subscriptions, "customer_interactions_raw": shapes.raw_customer_interactions,
    "product_catalog_raw": shapes.raw_product_catalog, "inventory_snapshots_raw": shapes.raw_inventory_snapshots,
    "marketing_campaigns_raw": shapes.raw_marketing_campaigns, "campaign_events_raw": shapes.raw_campaign_events,
}


def feed_files(spark: SparkSession, folder: str, base: str) -> dict[str, str]:
    """All feeds as files. Every hundredth campaign event has an arrival time that is none."""

    def write(name: str) -> str:
        feed = RAW[name](spark, folder).withColumn("_ingestion_timestamp", F.date_format("_ingestion_timestamp", TIME_TEXT))
        if name == "campaign_events_raw":
            feed = feed.withColumn("_ingestion_timestamp", F.when(
                F.col("_record_offset") % 100 == 0, F.concat(F.lit("late "), F.col("_record_offset"))).otherwise(F.col("_ingestion_timestamp")))
        # Compressed files are not split, so they are kept short. The fastest level takes a third of the time and a third more room.
        packed = feed.select(BRONZE[name].columns).write.option("maxRecordsPerFile", FEED_ROWS).option("zlib.compress.level", "BEST_SPEED")
        packed.csv(f"{base}/{name}", sep="|", header=True, quote='"', escape='"', compression="gzip")
        return f"{base}/{name}"

    return dict(zip(RAW, side_by_side(spark, write, list(RAW))))


def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads: all feeds, then three of them of which two are bad. What is published after both is that of the last good load."""
    base = scratch(spark, "load")
    files = feed_files(spark, folder, f"{base}/csv")
    again = {
        "product_catalog_raw": f"{base}/csv/not_there",
        "marketing_campaigns_raw": files["campaign_events_raw"],  # a header of another feed
        "inventory_snapshots_raw": files["inventory_snapshots_raw"],
    }
    loads = [load_feeds(spark, paths, f"{base}/bronze").withColumn("load", F.lit(number)) for number, paths in enumerate((files, again), 1)]
    kept = quality.row_counts(medallion.published(spark, f"{base}/bronze")).withColumnRenamed("row_count", "published_rows")
    report = loads[0].unionByName(loads[1]).join(kept, "table_name")
    return report.select("load", "table_name", "status", "row_count", "rejected_count", "published_rows")


def load_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Values of a feed that did not fit the contract, kept with their row's key, column and text."""
    base = scratch(spark, "quarantine")
    name = "campaign_events_raw"
    report = load_feeds(spark, {name: feed_files(spark, folder, f"{base}/csv")[name]}, f"{base}/bronze")
    return staging.read_quarantine(spark, report.first()["path"], BRONZE[name])


def bronze_since(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "bronze")
    writers.write_table(shapes.raw_transactions(spark, folder), path, BRONZE["transactions_raw"])
    recent = readers.arrived_since(readers.read_table(spark, path), "2001-01-01 00:00:00")
    return recent.groupBy(F.trunc("_ingestion_date", "MM").alias("month")).agg(F.count(F.lit(1)).alias("row_count"))


def dedupe_latest(spark: SparkSession, folder: str) -> DataFrame:
    feed = shapes.raw_transaction_items(spark, folder)
    latest = firsts.dedupe_latest(
        feed.select("transaction_id", "product_id", "quantity", "warehouse_id", "_ingestion_timestamp", "_record_offset"),
        ["transaction_id", "product_id"], ["_ingestion_timestamp", "_record_offset", "quantity", "warehouse_id"],
    )
    return as_text(latest, "_ingestion_timestamp")


def clean_template(spark: SparkSession, folder: str) -> DataFrame:
    feed = shapes.raw_transactions(spark, folder)
    padded = feed.withColumn("payment_method", F.concat(F.lit("  "), "payment_method"))
    return firsts.clean_feed(padded, ["transaction_id"], ["loyalty_points_redeemed"], ["payment_method"]).select(
        "transaction_id", "payment_method", "loyalty_points_redeemed"
    )


def validate_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    """The gate's view of the required feeds, of one that has no rows and of one that is not there."""
    tables = {name: RAW[name](spark, folder) for name in medallion.REQUIRED}
    tables["no_rows"] = readers.empty(spark, BRONZE["transactions_raw"])
    tables["not_there"] = lambda: readers.read_table(spark, f"{folder}/not_there.parquet")
    return quality.nonempty(spark, tables).drop("message")


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: RAW[name](spark, folder) for name in medallion.REQUIRED}


def table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = ("orders", "lineitem", "customer", "part", "events", "supplier", "nation", "region")
    return quality.row_counts({name: shapes.table(spark, folder, name) for name in names})


def cohort_without_subs(spark: SparkSession, folder: str) -> DataFrame:
    absent = readers.read_optional(spark, "silver_subscriptions_not_loaded", silver_contracts.SUBSCRIPTIONS)
    rows = cohorts.cohort_analysis(shapes.transactions(spark, folder), absent)
    return rows.select("cohort_month", cohorts.OFFSET, "cohort_size", "customers_active", "subscription_adoption_rate",
                       "avg_subscription_value")


# --- silver tables ----------------------------------------------------------

def silver_transactions(spark: SparkSession, folder: str) -> DataFrame:
    items = shapes.transaction_items(spark, folder)
    typed = silver.transactions_from_raw(shapes.raw_transactions(spark, folder), F.lit(RUN_TIME), items)
    typed = typed.withColumn("coupon_codes", F.array_join("coupon_codes", ","))
    return as_text(typed, "transaction_timestamp", "created_timestamp", "updated_timestamp")


def silver_items_economics(spark: SparkSession, folder: str) -> DataFrame:
    typed = silver.transaction_items_from_raw(shapes.raw_transaction_items(spark, folder), F.lit(RUN_TIME))
    return typed.drop("created_timestamp", "updated_timestamp", "source_system")


def silver_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    typed = silver.subscriptions_from_raw(shapes.raw_subscriptions(spark, folder), shapes.day(shapes.ORDERS_AS_OF), F.lit(RUN_TIME))
    return as_text(typed, "effective_start_date", "effective_end_date").drop(
        "created_timestamp", "updated_timestamp", "source_system"
    )


def silver_product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    typed = silver.product_catalog_from_raw(shapes.raw_product_catalog(spark, folder), shapes.day(shapes.ORDERS_AS_OF), F.lit(RUN_TIME))
    typed = typed.withColumn("tags", F.array_join("tags", ","))
    return as_text(typed, "effective_start_date", "effective_end_date").drop(
        "created_timestamp", "updated_timestamp", "source_system"
    )


def silver_inventory(spark: SparkSession, folder: str) -> DataFrame:
    typed = silver.inventory_from_raw(shapes.raw_inventory_snapshots(spark, folder), F.lit(RUN_TIME))
    return typed.drop("snapshot_timestamp", "created_timestamp", "source_system")


def silver_interactions(spark: SparkSession, folder: str) -> DataFrame:
    typed = silver.interactions_from_raw(shapes.raw_customer_interactions(spark, folder), F.lit(RUN_TIME))
    return as_text(typed, "interaction_timestamp").drop("created_timestamp", "source_system")


def silver_campaigns(spark: SparkSession, folder: str) -> DataFrame:
    typed = silver.campaigns_from_raw(shapes.raw_marketing_campaigns(spark, folder), F.lit(RUN_TIME))
    return typed.withColumn("audience_interests", F.array_join("audience_interests", ",")).drop(
        "created_timestamp", "source_system"
    )


def silver_campaign_events(spark: SparkSession, folder: str) -> DataFrame:
    typed = silver.campaign_events_from_raw(shapes.raw_campaign_events(spark, folder), F.lit(RUN_TIME))
    return typed.drop("event_timestamp", "created_timestamp", "source_system", "location")


def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of a part's selling terms, one per line shipped, as a slowly changing dimension."""
    lines = shapes.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.to_date("l_shipdate").alias("arrived"),
        (F.floor(F.col("l_quantity") / 25)).cast("int").alias("pack_class"), F.col("l_returnflag").alias("terms"),
    )
    return history.scd2_history(lines, "product_id", "arrived", ["pack_class", "terms"])


def scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    """The current version of each part's selling terms."""
    return scd2_history(spark, folder).filter("is_current").select("product_id", "pack_class", "terms", "effective_start_date")


def schema_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with other column order, other types, missing and further columns, under the contract of silver transactions."""
    loose = shapes.transactions(spark, folder).select(
        F.col("total_amount").cast("double").alias("total_amount"), F.lit("x").alias("not_declared"),
        F.col("customer_id").cast("string").alias("customer_id"), F.col("transaction_id").cast("decimal(20,0)").alias("transaction_id"),
        F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date"),
    )
    aligned = conform(loose, silver_contracts.SILVER["transactions"])
    return aligned.select("transaction_id", "customer_id", "transaction_date", "total_amount", "payment_method", F.size("coupon_codes").alias("coupons"))


def metadata_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """Load time and source system of silver rows."""
    typed = silver.interactions_from_raw(shapes.raw_customer_interactions(spark, folder), F.lit(RUN_TIME))
    return as_text(typed, "created_timestamp").groupBy("source_system", "created_timestamp").agg(F.count(F.lit(1)).alias("row_count"))


# --- single rules -----------------------------------------------------------

def code_to_id(spark: SparkSession, folder: str) -> DataFrame:
    raw = shapes.raw_transactions(spark, folder)
    return raw.select(
        text.code_to_id(F.col("transaction_id")).alias("transaction_id"),
        text.code_to_id(F.col("customer_id")).alias("customer_id"),
        text.code_to_id(F.col("store_id")).alias("store_id"),
        text.code_to_id(F.col("channel")).alias("digitless"),
        text.location_type(F.col("store_id")).alias("location_type"),
    )


def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("transaction_timestamp")
    return shapes.transactions(spark, folder).select("transaction_id", *[c.alias(n) for n, c in calendar.calendar_parts(ts).items()])


def fiscal_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.transactions(spark, folder).select("transaction_id", "transaction_date", "fiscal_year", "fiscal_quarter")


def first_purchase_flag(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.transactions_flagged(spark, folder).select("transaction_id", "customer_id", "is_first_purchase")


def holiday_flag(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.transactions(spark, folder).groupBy("transaction_date", "is_holiday").agg(F.count(F.lit(1)).alias("orders"))


def discount_coupon_flags(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.transactions(spark, folder).select("transaction_id", "has_discount", "has_coupon")


def subscription_payments(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.subscriptions(spark, folder).select(
        "subscription_id", "billing_frequency", "subscription_duration_days",
        ladders.payment_count(F.col("billing_frequency"), F.col("subscription_duration_days")).alias("total_payments_made"),
    )


def churn_risk_score(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.subscriptions(spark, folder).select("subscription_id", "status", "is_churned", "churn_risk_score")


def price_tier(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.product_catalog(spark, folder).select("product_id", "list_price", "price_tier")


def lifecycle_stage(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.product_catalog(spark, folder).select("product_id", "is_active", "product_age_days", "lifecycle_stage")


def category_path(spark: SparkSession, folder: str) -> DataFrame:
    gap = F.when(F.col("product_id") % 3 == 0, F.lit(None)).otherwise(F.col("category_level2"))
    return shapes.product_catalog(spark, folder).select(
        "product_id", "full_category_path",
        text.category_path(F.col("category_level1"), gap, F.col("category_level3")).alias("path_with_gap"),
    )


def escalation_flag(spark: SparkSession, folder: str) -> DataFrame:
    return shapes.customer_interactions(spark, folder).select("interaction_id", "notes_text", "is_escalated")


QUERIES = {
    f.__name__: f
    for f in (
        bronze_csv_roundtrip, load_report, load_quarantine, bronze_since, dedupe_latest, clean_template, validate_nonempty,
        table_row_counts, cohort_without_subs, silver_transactions, silver_items_economics, silver_subscriptions,
        silver_product_catalog, silver_inventory, silver_interactions, silver_campaigns, silver_campaign_events,
        scd2_history, scd2_current, schema_alignment, metadata_stamp, code_to_id, calendar_parts, fiscal_calendar, first_purchase_flag, holiday_flag,
        discount_coupon_flags, subscription_payments, churn_risk_score, price_tier, lifecycle_stage, category_path,
        escalation_flag,
    )
}
