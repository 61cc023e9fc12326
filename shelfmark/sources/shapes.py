"""The star-schema and event tables of a data folder, mapped to retail shapes.

``raw_*`` functions give text feeds as they would arrive (bronze); the others
give typed silver-shaped tables. Only columns that a query uses are computed:
Catalyst prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import calendar, ladders, numbers, text
from shelfmark.operators.firsts import with_first_purchase
from shelfmark.operators.silver import item_economics, stock_levels, subscription_terms

# Reporting days of the order tables and of the event tables.
ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"


def day(value: str) -> Column:
    return F.lit(value).cast("date")


# Schemas of the given tables; giving them saves one footer-reading job per read.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the folder, read as it is stored: filters and column pruning reach the scan."""
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def padded(prefix: str, column: str | Column, width: int) -> Column:
    number = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), width, "0"))


def pick(selector: Column, *values: str) -> Column:
    """The value at position ``selector`` (0-based)."""
    choice = F.lit(values[-1])
    for index in range(len(values) - 2, -1, -1):
        choice = F.when(selector == index, values[index]).otherwise(choice)
    return choice


# --- transactions -----------------------------------------------------------

def _order_terms() -> dict[str, Column]:
    key = F.col("o_orderkey")
    return {
        "transaction_timestamp": F.expr("o_orderdate + make_dt_interval(0, CAST(o_orderkey % 24 AS INT), 0, 0)"),
        "channel": (
            F.when(F.col("o_orderpriority") == "1-URGENT", "online")
            .when(F.col("o_orderpriority") == "2-HIGH", "mobile")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "in-store").otherwise("marketplace")
        ),
        "payment_method": pick(key % 3, "credit_card", "paypal", "cash"),
        "payment_status": (
            F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending")
            .otherwise("failed")
        ),
        "total_amount": F.col("o_totalprice").cast("decimal(12,2)"),
        "shipping_cost": ((key % 5) * F.lit(2.5).cast("decimal(2,1)")).cast("decimal(12,2)"),
        "loyalty_points_earned": (key % 500).cast("int"),
        "loyalty_points_redeemed": (key % 7 * 10).cast("int"),
        "coupon_text": (
            F.when(key % 4 == 0, F.lit(None)).when(key % 4 == 1, "[]")
            .otherwise(F.concat(F.lit('["VIP'), (key % 10).cast("string"), F.lit('","FREESHIP"]')))
        ),
    }


def _order_amounts() -> dict[str, Column]:
    total = F.col("total_amount")
    tenth = (total * F.lit("0.10").cast("decimal(3,2)")).cast("decimal(12,2)")
    return {
        "tax_amount": (total * F.lit("0.08").cast("decimal(3,2)")).cast("decimal(12,2)"),
        "discount_amount": F.when(F.col("o_orderkey") % 3 == 0, tenth).otherwise(F.lit(0).cast("decimal(12,2)")),
    }


def _orders_with_store(spark: SparkSession, folder: str) -> DataFrame:
    homes = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return (
        table(spark, folder, "orders").join(homes, "o_custkey", "left")
        .withColumns(_order_terms()).withColumns(_order_amounts())
        .withColumn(
            "subtotal",
            (F.col("total_amount") - F.col("tax_amount") - F.col("shipping_cost") + F.col("discount_amount"))
            .cast("decimal(12,2)"),
        )
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Silver transactions; ``is_first_purchase`` is added by ``transactions_flagged``."""
    ts = F.col("transaction_timestamp")
    coupons = text.json_strings(F.col("coupon_text"))
    typed = _orders_with_store(spark, folder).select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        "transaction_timestamp",
        F.to_date(ts).alias("transaction_date"),
        "channel",
        F.col("c_nationkey").cast("bigint").alias("store_id"),
        "payment_method", "payment_status", "subtotal", "tax_amount", "shipping_cost", "discount_amount",
        "total_amount",
        F.lit("USD").alias("currency"),
        "loyalty_points_earned", "loyalty_points_redeemed",
        coupons.alias("coupon_codes"),
    )
    return typed.withColumns(
        {
            **calendar.calendar_parts(ts),
            "is_holiday": calendar.is_holiday(F.col("transaction_date")),
            "fiscal_year": calendar.fiscal_year(F.col("transaction_date")),
            "fiscal_quarter": calendar.fiscal_quarter(F.col("transaction_date")),
            "has_discount": F.col("discount_amount") > 0,
            "has_coupon": text.has_entries(F.col("coupon_codes")),
        }
    )


def transactions_flagged(spark: SparkSession, folder: str) -> DataFrame:
    return with_first_purchase(transactions(spark, folder))


def stores(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region")
    return table(spark, folder, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").cast("bigint").alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.col("r_name").alias("store_region"),
    )


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    floor_sale = F.col("channel") == "in-store"
    return _orders_with_store(spark, folder).select(
        padded("TXN", "o_orderkey", 12).alias("transaction_id"),
        padded("CUST", "o_custkey", 12).alias("customer_id"),
        F.date_format("transaction_timestamp", "yyyy-MM-dd HH:mm:ss").alias("transaction_timestamp"),
        F.when(floor_sale, "store").otherwise(F.col("channel")).alias("channel"),
        F.when(floor_sale, padded("STR", "c_nationkey", 3)).alias("store_id"),
        "payment_method", "payment_status",
        *[F.col(name).cast("string").alias(name) for name in (
            "subtotal", "tax_amount", "shipping_cost", "discount_amount", "total_amount")],
        F.lit("USD").alias("currency"),
        F.col("loyalty_points_earned").cast("string").alias("loyalty_points_earned"),
        F.col("loyalty_points_redeemed").cast("string").alias("loyalty_points_redeemed"),
        F.col("coupon_text").alias("coupon_codes"),
        *audit("orders", "o_orderdate", "o_orderkey"),
    )


def audit(source: str, when: str, offset: str) -> list[Column]:
    """The four audit columns of a feed that arrives in monthly batches, typed as in bronze."""
    return [
        F.lit(f"{source}_feed").alias("_source_system"),
        F.trunc(when, "MM").cast("timestamp").alias("_ingestion_timestamp"),
        F.concat(F.lit(f"{source}_"), F.date_format(when, "yyyyMM"), F.lit(".json")).alias("_file_name"),
        F.col(offset).cast("bigint").alias("_record_offset"),
    ]


# --- items and products -----------------------------------------------------

def _lines(spark: SparkSession, folder: str) -> DataFrame:
    prices = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    return table(spark, folder, "lineitem").join(prices, "l_partkey", "left")


def _line_columns() -> list[Column]:
    quantity = F.col("l_quantity").cast("int")
    returned = F.col("l_returnflag") == "R"
    return [
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_item_id"),
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber") % 3).alias("variant_id"),
        quantity.alias("quantity"),
        F.when(returned, quantity).otherwise(0).alias("return_quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_percentage"),
        F.col("l_tax").cast("decimal(5,4)").alias("tax_rate"),
        F.when(returned, pick(F.col("l_linenumber") % 3, "defective", "changed_mind", "wrong_item"))
        .alias("return_reason"),
        F.when(F.col("l_linestatus") == "O", "processing").otherwise("shipped").alias("fulfillment_status"),
        F.col("l_suppkey").alias("warehouse_id"),
    ]


def transaction_items(spark: SparkSession, folder: str) -> DataFrame:
    return item_economics(_lines(spark, folder).select(*_line_columns()))


def raw_transaction_items(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    as_text = {
        "transaction_item_id": F.concat(F.lit("TXNI"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")),
        "transaction_id": padded("TXN", "l_orderkey", 12),
        "product_id": F.concat(F.lit("PROD"), F.col("l_partkey").cast("string")),
        "variant_id": F.concat(F.lit("VAR"), (F.col("l_partkey") * 10 + F.col("l_linenumber") % 3).cast("string")),
        "warehouse_id": padded("WH", "l_suppkey", 9),
    }
    typed = lines.select(
        *_line_columns(),
        *[column.alias(f"raw_{name}") for name, column in as_text.items()],
        *audit("lineitem", "l_shipdate", "l_linenumber"),
    )
    order = (
        "transaction_item_id transaction_id product_id variant_id quantity unit_price discount_percentage tax_rate "
        "return_quantity return_reason fulfillment_status warehouse_id"
    ).split()
    return typed.select(
        *[F.col(f"raw_{n}").alias(n) if n in as_text else F.col(n).cast("string").alias(n) for n in order],
        "_source_system", "_ingestion_timestamp", "_file_name", "_record_offset",
    )


def _part_columns() -> list[Column]:
    word = F.split("p_name", " ")
    launch = F.date_add(day("1995-01-01"), (F.col("p_partkey") % 2000).cast("int"))
    return [
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_level1"),
        F.get(word, F.lit(1)).alias("category_level2"),
        F.get(word, F.lit(0)).alias("category_level3"),
        F.col("p_brand").alias("brand"),
        F.concat(F.lit("Maker of "), F.col("p_brand")).alias("manufacturer"),
        # Prices of the given parts all lie near 900; a spread by size reaches every price tier.
        (F.col("p_retailprice") * F.col("p_size") / 50).cast("decimal(10,2)").alias("list_price"),
        F.col("p_partkey").alias("supplier_id"),
        (F.col("p_size") % 14).alias("lead_time_days"),
        launch.alias("launch_date"),
        F.when(F.col("p_size") > 45, F.date_add(launch, 400)).alias("discontinuation_date"),
    ]


def product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    age = F.date_diff(day(ORDERS_AS_OF), F.col("launch_date"))
    active = F.col("discontinuation_date").isNull()
    cost = (F.col("list_price") * F.lit("0.60").cast("decimal(3,2)")).cast("decimal(10,2)")
    return table(spark, folder, "part").select(*_part_columns()).withColumns(
        {
            "full_category_path": text.category_path(*[F.col(f"category_level{i}") for i in (1, 2, 3)]),
            "unit_cost": cost,
            "price_tier": ladders.price_tier(F.col("list_price")),
            "is_active": active,
            "product_age_days": age,
            "lifecycle_stage": ladders.lifecycle_stage(active, age),
            "is_current": F.lit(True),
        }
    ).withColumn(
        "margin_percentage",
        numbers.as_decimal(numbers.percent(F.col("list_price") - F.col("unit_cost"), F.col("list_price")), 12, 2),
    )


def raw_product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    cost = (F.col("list_price") * F.lit("0.60").cast("decimal(3,2)")).cast("decimal(10,2)")
    typed = parts.select(*_part_columns(), "p_size").withColumn("unit_cost", cost)
    return typed.select(
        padded("PROD", "product_id", 9).alias("product_id"),
        "product_name", "category_level1", "category_level2", "category_level3", "brand", "manufacturer",
        F.col("unit_cost").cast("string").alias("unit_cost"),
        F.col("list_price").cast("string").alias("list_price"),
        F.lit(None).cast("string").alias("margin_percentage"),
        padded("SUP", "supplier_id", 9).alias("supplier_id"),
        F.col("lead_time_days").cast("string").alias("lead_time_days"),
        (F.col("p_size") / 10).cast("decimal(8,3)").cast("string").alias("weight_kg"),
        F.concat(F.lit('{"length":'), F.col("p_size").cast("string"), F.lit("}")).alias("dimensions"),
        F.concat(F.lit('["'), F.col("category_level3"), F.lit('","'), F.col("category_level2"), F.lit('"]')).alias("tags"),
        F.col("launch_date").cast("string").alias("launch_date"),
        F.coalesce(F.col("discontinuation_date").cast("string"), F.lit("")).alias("discontinuation_date"),
        F.lit("part_feed").alias("_source_system"),
        day(ORDERS_AS_OF).cast("timestamp").alias("_ingestion_timestamp"),
        F.lit("products.json").alias("_file_name"),
        F.col("supplier_id").alias("_record_offset"),
    )


# --- subscriptions ----------------------------------------------------------

def _subscription_columns() -> list[Column]:
    key = F.col("o_orderkey")
    start = F.to_date("o_orderdate")
    status = pick(F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2),
                  "active", "cancelled", "paused")
    open_ended = (F.col("o_orderstatus") == "O") & (key % 2 == 0)
    end = F.date_add(start, (key % 720).cast("int"))
    return [
        key.alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        pick(key % 3, "basic", "premium", "premium_plus").alias("subscription_type"),
        (F.col("o_custkey") % 5).alias("plan_id"),
        start.alias("start_date"),
        F.when(~open_ended, end).alias("end_date"),
        F.when(F.col("o_orderstatus") == "F", end).alias("cancellation_date"),
        F.date_add(start, 30).alias("next_billing_date"),
        status.alias("status"),
        pick(key % 3, "monthly", "quarterly", "annual").alias("billing_frequency"),
        (key % 4 != 3).alias("auto_renewal"),
        F.when(F.col("o_orderstatus") == "F", pick(key % 4, "too_expensive", "not_used", "payment_failed", "moved"))
        .alias("cancellation_reason"),
        (F.lit("9.99").cast("decimal(5,2)") + (key % 5) * 10).cast("decimal(10,2)").alias("subscription_amount"),
    ]


def subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    typed = table(spark, folder, "orders").select(*_subscription_columns())
    return subscription_terms(typed, day(ORDERS_AS_OF))


def raw_subscriptions(spark: SparkSession, folder: str) -> DataFrame:
    typed = table(spark, folder, "orders").select(*_subscription_columns(), *audit("subs", "o_orderdate", "o_orderkey"))
    text_of = lambda name: F.col(name).cast("string").alias(name)
    return typed.select(
        padded("SUB", "subscription_id", 12).alias("subscription_id"),
        padded("CUST", "customer_id", 12).alias("customer_id"),
        "subscription_type",
        padded("PLAN", "plan_id", 3).alias("plan_id"),
        text_of("start_date"), text_of("end_date"), "status", "billing_frequency", text_of("subscription_amount"),
        text_of("next_billing_date"),
        F.when(F.col("auto_renewal"), "True").otherwise("false").alias("auto_renewal"),
        F.coalesce(F.col("cancellation_date").cast("string"), F.lit("")).alias("cancellation_date"),
        "cancellation_reason",
        "_source_system", "_ingestion_timestamp", "_file_name", "_record_offset",
    )


# --- interactions, inventory, campaigns -------------------------------------

def _interaction_columns() -> list[Column]:
    key = F.col("event_id")
    return [
        key.alias("interaction_id"),
        F.col("user_id").alias("customer_id"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("interaction_timestamp"),
        F.to_date("ts").alias("interaction_date"),
        F.col("event_type").alias("interaction_type"),
        pick(key % 4, "email", "web", "phone", "social").alias("channel"),
        (key % 17).alias("agent_id"),
        pick(key % 3, "billing", "order_issue", "product_inquiry").alias("category"),
        pick(key % 5, "refund", "delay", "specifications", "renewal", "login").alias("subcategory"),
        F.when(key % 11 != 0, ((key % 201 - 100) * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(3,2)"))
        .alias("sentiment_score"),
        (key % 240).cast("int").alias("resolution_time_minutes"),
        F.when(key % 6 != 0, (key % 6).cast("int")).alias("satisfaction_rating"),
        pick(key % 7, "Will escalate by letter", "Handled at once", "URGENT: call back", "Asked for a Supervisor",
             "Follow-up sent", "Resolved").alias("notes_text"),
    ]


def customer_interactions(spark: SparkSession, folder: str) -> DataFrame:
    rated = (F.col("satisfaction_rating") > 0) & (F.col("resolution_time_minutes") > 0)
    return table(spark, folder, "events").select(*_interaction_columns()).withColumns(
        {
            "is_resolved": F.coalesce(rated, F.lit(False)),
            "is_escalated": text.is_escalated(F.col("notes_text")),
            "interaction_year": F.year("interaction_date"),
            "interaction_month": F.month("interaction_date"),
        }
    )


def raw_customer_interactions(spark: SparkSession, folder: str) -> DataFrame:
    typed = table(spark, folder, "events").select(*_interaction_columns(), *audit("events", "ts", "event_id"))
    text_of = lambda name: F.col(name).cast("string").alias(name)
    return typed.select(
        padded("INT", "interaction_id", 12).alias("interaction_id"),
        padded("CUST", "customer_id", 12).alias("customer_id"),
        F.date_format("interaction_timestamp", "yyyy-MM-dd HH:mm:ss").alias("interaction_timestamp"),
        "interaction_type", "channel", padded("AGT", "agent_id", 3).alias("agent_id"), "category", "subcategory",
        text_of("sentiment_score"), text_of("resolution_time_minutes"), text_of("satisfaction_rating"),
        F.col("notes_text").alias("notes"),
        "_source_system", "_ingestion_timestamp", "_file_name", "_record_offset",
    )


def _snapshot_columns() -> list[Column]:
    return [
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("snapshot_id"),
        F.col("l_shipdate").alias("snapshot_timestamp"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber") % 3).alias("variant_id"),
        F.col("l_suppkey").alias("warehouse_id"),
        F.col("p_size").alias("quantity_on_hand"),
        F.col("l_quantity").cast("int").alias("quantity_reserved"),
        (F.col("p_size") % 20).alias("reorder_point"),
        (F.col("p_size") * 2).alias("reorder_quantity"),
    ]


def _stocked_lines(spark: SparkSession, folder: str) -> DataFrame:
    sizes = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return table(spark, folder, "lineitem").join(sizes, "l_partkey", "left")


def inventory_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return stock_levels(_stocked_lines(spark, folder).select(*_snapshot_columns()))


def raw_inventory_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    typed = _stocked_lines(spark, folder).select(*_snapshot_columns(), *audit("stock", "l_shipdate", "l_linenumber"))
    text_of = lambda name: F.col(name).cast("string").alias(name)
    return typed.select(
        F.concat(F.lit("SNAP"), F.col("snapshot_id").cast("string")).alias("snapshot_id"),
        F.date_format("snapshot_timestamp", "yyyy-MM-dd HH:mm:ss").alias("snapshot_timestamp"),
        padded("PROD", "product_id", 9).alias("product_id"),
        F.concat(F.lit("VAR"), F.col("variant_id").cast("string")).alias("variant_id"),
        padded("WH", "warehouse_id", 9).alias("warehouse_id"),
        text_of("quantity_on_hand"), text_of("quantity_reserved"),
        F.lit(None).cast("string").alias("quantity_available"),
        text_of("reorder_point"), text_of("reorder_quantity"),
        "_source_system", "_ingestion_timestamp", "_file_name", "_record_offset",
    )


def raw_marketing_campaigns(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    start = F.date_add(day("2024-01-01"), (key % 20).cast("int"))
    budget = (F.abs(F.col("s_acctbal")) + 100).cast("decimal(12,2)")
    return table(spark, folder, "supplier").select(
        padded("CAMP", "s_suppkey", 9).alias("campaign_id"),
        F.concat(F.lit("Campaign "), F.col("s_name")).alias("campaign_name"),
        pick(key % 5, "email", "social", "display", "search", "affiliate").alias("campaign_type"),
        pick(key % 4, "email", "facebook", "google_ads", "instagram").alias("channel"),
        start.cast("string").alias("start_date"),
        F.date_add(start, 30).cast("string").alias("end_date"),
        budget.cast("string").alias("budget"),
        F.concat(
            F.lit('{"age_range":"18-99","interests":["sample","kind-'), (key % 3).cast("string"),
            F.lit('"],"segment":"segment-'), (key % 6).cast("string"), F.lit('"}'),
        ).alias("target_audience"),
        padded("CRE", "s_suppkey", 9).alias("creative_id"),
        F.lit("supplier_feed").alias("_source_system"),
        day("2024-01-01").cast("timestamp").alias("_ingestion_timestamp"),
        F.lit("campaigns.json").alias("_file_name"),
        key.alias("_record_offset"),
    )


def raw_campaign_events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        padded("EVT", "event_id", 12).alias("event_id"),
        padded("CAMP", F.get_json_object("props", "$.k").cast("int"), 9).alias("campaign_id"),
        padded("CUST", "user_id", 12).alias("customer_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_timestamp"),
        F.when(kind == "view", "impression").when(kind == "purchase", "conversion").when(kind == "error", "unsubscribe")
        .otherwise(kind).alias("event_type"),
        pick(F.col("event_id") % 3, "mobile", "desktop", "tablet").alias("device_type"),
        pick(F.col("event_id") % 4, "New York", "Los Angeles", "Chicago", "Boston").alias("location"),
        F.when(kind == "purchase", F.col("value").cast("decimal(12,2)")).otherwise(F.lit(0)).cast("decimal(12,2)")
        .cast("string").alias("attributed_revenue"),
        *audit("events", "ts", "event_id"),
    )


def touchpoints(spark: SparkSession, folder: str) -> DataFrame:
    """Events as journey touches: purchases are conversions, every other type is a plain touch."""
    bought = F.col("event_type") == "purchase"
    return table(spark, folder, "events").select(
        F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("touch_id"),
        F.col("ts").alias("touch_timestamp"),
        F.when(bought, pick(F.col("event_id") % 4, *ladders.SALES_CHANNELS)).otherwise(F.col("event_type")).alias("channel"),
        F.get_json_object("props", "$.k").cast("bigint").alias("campaign_id"),
        F.when(bought, "purchase").otherwise("interaction").alias("event_type"),
        F.when(bought, F.col("value").cast("decimal(12,2)")).otherwise(F.lit(0).cast("decimal(12,2)")).alias("revenue"),
    )


def dated_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Interactions on days of the years that the orders are of, so that they can precede purchases."""
    talks = customer_interactions(spark, folder)
    back = F.make_dt_interval(days=F.lit(8200) + F.col("interaction_id") % 2300)
    return talks.withColumn("interaction_timestamp", F.col("interaction_timestamp") - back)


def query_log(spark: SparkSession, folder: str) -> DataFrame:
    """A statement log derived from the event stream: one logged statement per event."""
    number = F.col("event_id")
    part = lambda modulo: (number % modulo).cast("string")
    bronze = F.concat(F.lit("bronze.feed_"), part(7))
    silver = F.concat(F.lit("silver.table_"), part(5))
    gold = F.concat(F.lit("gold.mart_"), part(3))
    joined = lambda *pieces: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])
    statement = (
        F.when(number % 4 == 0, joined(
            "INSERT OVERWRITE TABLE ", silver, " SELECT * FROM ", bronze, " -- FROM bronze.ignored\n WHERE id > 0"))
        .when(number % 4 == 1, joined(
            "INSERT INTO ", gold, " WITH base AS (SELECT * FROM ", silver, "), totals AS (SELECT count(*) n FROM base",
            " JOIN silver.calendar ON 1 = 1) SELECT * FROM totals /* JOIN bronze.ignored */"))
        .when(number % 4 == 2, joined(
            "CREATE TABLE ", gold, " USING PARQUET LOCATION 's3a://data/mart/", part(3), "' AS SELECT * FROM ", silver,
            " JOIN ", bronze, " USING (id)"))
        .otherwise(joined("SELECT count(*) FROM ", silver))
    )
    return table(spark, folder, "events").select(
        F.concat(F.lit("job_"), part(12)).alias("job"),
        F.col("event_id").alias("statement_id"),
        statement.alias("sql_text"),
    )


def _node(kind: str, *columns: str) -> Column:
    return F.concat(F.lit(f"{kind}:"), F.concat_ws("-", *columns))


def flow_reads(spark: SparkSession, folder: str) -> DataFrame:
    """What jobs read: a lot, one supplier's deliveries of a part, the supplier; packing an order its parts; billing the order."""
    lines = table(spark, folder, "lineitem")
    lots = lines.select(_node("lot", "l_suppkey", "l_partkey").alias("job"), _node("supplier", "l_suppkey").alias("source"))
    packed = lines.select(_node("pack", "l_orderkey").alias("job"), _node("part", "l_partkey").alias("source"))
    billed = table(spark, folder, "orders").select(_node("bill", "o_orderkey").alias("job"), _node("order", "o_orderkey").alias("source"))
    return lots.unionByName(packed).unionByName(billed)


def flow_writes(spark: SparkSession, folder: str) -> DataFrame:
    """What jobs write: a lot its part, packing the order, billing the customer."""
    lines = table(spark, folder, "lineitem")
    lots = lines.select(_node("lot", "l_suppkey", "l_partkey").alias("job"), _node("part", "l_partkey").alias("target"), F.lit("SUPPLY").alias("op"))
    packed = lines.select(_node("pack", "l_orderkey").alias("job"), _node("order", "l_orderkey").alias("target"), F.lit("PACK").alias("op"))
    return lots.unionByName(packed).unionByName(table(spark, folder, "orders").select(
        _node("bill", "o_orderkey").alias("job"), _node("customer", "o_custkey").alias("target"), F.lit("BILL").alias("op")))


def flow_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Steps inside the packing of an order: its lines, each with the part it takes."""
    return table(spark, folder, "lineitem").select(
        _node("pack", "l_orderkey").alias("job"), _node("line", "l_orderkey", "l_linenumber").alias("step"), _node("part", "l_partkey").alias("source"))
