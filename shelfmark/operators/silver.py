"""Bronze to silver: typing and enrichment of the eight feeds.

Each ``*_from_raw`` function takes a raw feed and returns the silver table. The
derivations shared with already typed input are separate functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.contracts import Contract, conform
from shelfmark.contracts import silver as tables
from shelfmark.functions import calendar, ladders, numbers, text
from shelfmark.operators.firsts import with_first_purchase
from shelfmark.sources.readers import FEED_TIME

# Fixed value: cost of goods as a share of the unit price.
COST_SHARE = "0.70"

# Supply horizon in days, and the value for "no reorder point".
SUPPLY_HORIZON_DAYS = 30
NO_REORDER_DAYS = 999

AUDIENCE = "age_range string, interests array<string>, segment string"


def _ids(*names: str) -> dict[str, Column]:
    return {name: text.code_to_id(F.col(name)) for name in names}


def _typed(target: Contract, *names: str) -> dict[str, Column]:
    kinds = dict(target.fields)
    return {name: F.col(name).try_cast(kinds[name]) for name in names}


def _moment(name: str) -> Column:
    return F.try_to_timestamp(F.col(name), F.lit(FEED_TIME))


def _date(name: str) -> Column:
    return F.col(name).try_cast("date")


def stamped(df: DataFrame, run_ts: Column) -> DataFrame:
    """Origin and load time; ``run_ts`` is given so that a rerun gives the same rows."""
    return df.withColumns(
        {
            "source_system": F.col("_source_system"),
            "created_timestamp": run_ts.cast("timestamp"),
            "updated_timestamp": run_ts.cast("timestamp"),
        }
    )


# --- transactions -----------------------------------------------------------

def transactions_from_raw(raw: DataFrame, run_ts: Column, items: DataFrame | None = None) -> DataFrame:
    """33-column silver transactions. With silver ``items`` the return flag is computed from them."""
    target = tables.TRANSACTIONS
    ts, day = F.col("transaction_timestamp"), F.col("transaction_date")
    typed = (
        raw.withColumns(
            {
                **_ids("transaction_id", "customer_id", "store_id"),
                **_typed(target, "subtotal", "tax_amount", "shipping_cost", "discount_amount", "total_amount",
                         "loyalty_points_earned", "loyalty_points_redeemed"),
                "transaction_timestamp": _moment("transaction_timestamp"),
                "channel": text.normalise_channel(F.col("channel")),
                "coupon_codes": text.json_strings(F.col("coupon_codes")),
            }
        )
        .withColumn("transaction_date", F.to_date("transaction_timestamp"))
        .withColumns(
            {
                **calendar.calendar_parts(ts),
                "is_holiday": calendar.is_holiday(day),
                "fiscal_year": calendar.fiscal_year(day),
                "fiscal_quarter": calendar.fiscal_quarter(day),
                "has_discount": F.coalesce(F.col("discount_amount") > 0, F.lit(False)),
                "has_coupon": text.has_entries(F.col("coupon_codes")),
            }
        )
    )
    flagged = with_first_purchase(stamped(typed, run_ts))
    if items is None:
        flagged = flagged.withColumn("is_return_transaction", F.lit(False))
    else:
        flagged = with_return_flag(flagged, items)
    return conform(flagged, target)


def with_return_flag(txns: DataFrame, items: DataFrame) -> DataFrame:
    """True for a transaction with at least one returned line."""
    returned = (
        items.groupBy("transaction_id").agg(F.max(F.col("return_quantity") > 0).alias("is_return_transaction"))
    )
    joined = txns.drop("is_return_transaction").join(returned, "transaction_id", "left")
    return joined.withColumn("is_return_transaction", F.coalesce("is_return_transaction", F.lit(False)))


# --- items ------------------------------------------------------------------

def item_economics(lines: DataFrame) -> DataFrame:
    """Line amounts in exact decimals; each is rounded once, at the end.

    ``line_profit`` sets the cost of the kept units against the revenue of all
    units. ``net_line_revenue`` is the untaxed revenue of the kept units, which
    the marts use for profit.
    """
    cents = lambda column: column.cast("decimal(12,2)")
    based = lines.withColumns(
        {
            "net_quantity": F.col("quantity") - F.col("return_quantity"),
            "unit_cost": (F.col("unit_price") * F.lit(COST_SHARE).cast("decimal(3,2)")).cast("decimal(10,2)"),
        }
    ).withColumns(
        {
            "_sub": cents(F.col("quantity") * F.col("unit_price")),
            "_kept": cents(F.col("net_quantity") * F.col("unit_price")),
            "_off": F.col("discount_percentage") * F.lit("0.01").cast("decimal(3,2)"),
        }
    )
    discounted = F.col("_sub") - F.col("_sub") * F.col("_off")
    tax = discounted * F.col("tax_rate")
    total = discounted + tax
    cost = cents(F.col("net_quantity") * F.col("unit_cost"))
    margin = F.when(total > 0, numbers.percent(total - cost, total)).otherwise(0.0)
    return based.withColumns(
        {
            "line_subtotal": F.col("_sub"),
            "line_discount": cents(F.col("_sub") * F.col("_off")),
            "line_tax": cents(tax),
            "line_total": cents(total),
            "line_cost": cost,
            "line_profit": cents(total - cost),
            "line_margin_percentage": numbers.as_decimal(margin, 12, 2),
            "net_line_revenue": cents(F.col("_kept") - F.col("_kept") * F.col("_off")),
        }
    ).drop("_sub", "_kept", "_off")


def transaction_items_from_raw(raw: DataFrame, run_ts: Column) -> DataFrame:
    target = tables.TRANSACTION_ITEMS
    zero = lambda name, kind: F.coalesce(F.col(name).try_cast(kind), F.lit(0).cast(kind))
    typed = raw.withColumn("location_type", text.location_type(F.col("warehouse_id"))).withColumns(
        {
            **_ids("transaction_item_id", "transaction_id", "product_id", "variant_id", "warehouse_id"),
            **_typed(target, "quantity", "unit_price"),
            "return_quantity": zero("return_quantity", "int"),
            "discount_percentage": zero("discount_percentage", "decimal(5,2)"),
            "tax_rate": zero("tax_rate", "decimal(5,4)"),
        }
    )
    return conform(stamped(item_economics(typed), run_ts), target)


# --- subscriptions ----------------------------------------------------------

def subscription_terms(typed: DataFrame, as_of: Column) -> DataFrame:
    """Duration, payments, lifetime value, churn flag and churn risk as of one day."""
    ended = F.col("cancellation_date").isNotNull() | F.col("status").isin("cancelled", "expired")
    running_to = F.coalesce(F.col("end_date"), as_of)
    return (
        typed.withColumns(
            {
                "subscription_duration_days": F.coalesce(
                    F.greatest(F.date_diff(running_to, F.col("start_date")), F.lit(0)), F.lit(0)
                ),
                "is_churned": F.coalesce(ended, F.lit(False)),
            }
        )
        .withColumn(
            "total_payments_made",
            ladders.payment_count(F.col("billing_frequency"), F.col("subscription_duration_days")),
        )
        .withColumns(
            {
                "lifetime_value": (F.col("subscription_amount") * F.col("total_payments_made")).cast("decimal(12,2)"),
                "churn_risk_score": ladders.churn_risk(
                    F.col("is_churned"), F.col("status"), F.col("auto_renewal"),
                    F.date_diff(F.col("end_date"), as_of), F.col("total_payments_made"),
                ),
            }
        )
    )


def subscriptions_from_raw(raw: DataFrame, as_of: Column, run_ts: Column) -> DataFrame:
    target = tables.SUBSCRIPTIONS
    typed = raw.withColumns(
        {
            **_ids("subscription_id", "customer_id", "plan_id"),
            **_typed(target, "subscription_amount"),
            **{name: _date(name) for name in ("start_date", "end_date", "cancellation_date", "next_billing_date")},
            "auto_renewal": text.truthy(F.col("auto_renewal")),
        }
    )
    return conform(as_current(stamped(subscription_terms(typed, as_of), run_ts), run_ts), target)


def as_current(df: DataFrame, run_ts: Column) -> DataFrame:
    """Interval columns of a first load: one open interval per row."""
    return df.withColumns(
        {
            "effective_start_date": run_ts.cast("timestamp"),
            "effective_end_date": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


# --- products ---------------------------------------------------------------

def product_catalog_from_raw(raw: DataFrame, as_of: Column, run_ts: Column) -> DataFrame:
    target = tables.PRODUCT_CATALOG
    levels = [F.col(f"category_level{i}") for i in (1, 2, 3)]
    typed = raw.withColumns(
        {
            **_ids("product_id", "supplier_id"),
            **_typed(target, "unit_cost", "list_price"),
            "lead_time_days": F.coalesce(F.col("lead_time_days").try_cast("int"), F.lit(0)),
            "weight_kg": F.coalesce(F.col("weight_kg").try_cast("decimal(8,3)"), F.lit(0).cast("decimal(8,3)")),
            "launch_date": _date("launch_date"),
            "discontinuation_date": _date("discontinuation_date"),
            "full_category_path": text.category_path(*levels),
            "tags": F.when(F.col("tags") != "[]", text.json_strings(F.col("tags"))),
        }
    )
    age = F.coalesce(F.date_diff(as_of, F.col("launch_date")), F.lit(0))
    active = F.col("discontinuation_date").isNull()
    margin = numbers.percent(F.col("list_price") - F.col("unit_cost"), F.col("list_price"))
    enriched = typed.withColumns(
        {
            "margin_percentage": numbers.as_decimal(F.when(F.col("list_price") > 0, margin).otherwise(0.0), 12, 2),
            "price_tier": ladders.price_tier(F.col("list_price")),
            "is_active": active,
            "product_age_days": age,
            "lifecycle_stage": ladders.lifecycle_stage(active, age),
        }
    )
    return conform(as_current(stamped(enriched, run_ts), run_ts), target)


# --- inventory and interactions ---------------------------------------------

def stock_levels(typed: DataFrame) -> DataFrame:
    """Available units, days of supply and stock status."""
    available, point = F.col("quantity_available"), F.col("reorder_point")
    cover = F.floor(F.try_divide(F.abs(available) * SUPPLY_HORIZON_DAYS, point)) * F.signum(available)
    out = available <= 0
    return typed.withColumn(
        "quantity_available", F.col("quantity_on_hand") - F.coalesce(F.col("quantity_reserved"), F.lit(0))
    ).withColumns(
        {
            "days_of_supply": F.when(point > 0, cover.cast("int")).otherwise(NO_REORDER_DAYS),
            "stock_status": ladders.stock_status(available, point),
            "is_stockout": F.coalesce(out, F.lit(False)),
            "stockout_duration_days": F.when(out, 1).otherwise(0),
        }
    )


def inventory_from_raw(raw: DataFrame, run_ts: Column) -> DataFrame:
    target = tables.INVENTORY_SNAPSHOTS
    typed = raw.withColumns(
        {
            **_ids("snapshot_id", "product_id", "variant_id", "warehouse_id"),
            **_typed(target, "quantity_on_hand", "quantity_reserved", "reorder_point", "reorder_quantity"),
            "snapshot_timestamp": _moment("snapshot_timestamp"),
        }
    ).withColumn("snapshot_date", F.to_date("snapshot_timestamp"))
    return conform(stamped(stock_levels(typed), run_ts), target)


def interactions_from_raw(raw: DataFrame, run_ts: Column) -> DataFrame:
    target = tables.CUSTOMER_INTERACTIONS
    typed = raw.withColumns(
        {
            **_ids("interaction_id", "customer_id", "agent_id"),
            **_typed(target, "sentiment_score", "resolution_time_minutes", "satisfaction_rating"),
            "interaction_timestamp": _moment("interaction_timestamp"),
            "is_escalated": text.is_escalated(F.col("notes")),
        }
    ).withColumn("interaction_date", F.to_date("interaction_timestamp"))
    rated = (F.col("satisfaction_rating") > 0) & (F.col("resolution_time_minutes") > 0)
    enriched = typed.withColumns(
        {
            "is_resolved": F.coalesce(rated, F.lit(False)),
            "interaction_year": F.year("interaction_date"),
            "interaction_month": F.month("interaction_date"),
        }
    )
    return conform(stamped(enriched, run_ts), target)


# --- campaigns --------------------------------------------------------------

def campaigns_from_raw(raw: DataFrame, run_ts: Column) -> DataFrame:
    target = tables.MARKETING_CAMPAIGNS
    typed = raw.withColumns(
        {
            **_ids("campaign_id", "creative_id"),
            **_typed(target, "budget"),
            "start_date": _date("start_date"),
            "end_date": _date("end_date"),
            "_audience": F.from_json("target_audience", AUDIENCE),
        }
    ).withColumns(
        {
            "duration_days": F.date_diff("end_date", "start_date") + 1,
            "audience_age_range": F.col("_audience.age_range"),
            "audience_interests": F.col("_audience.interests"),
            "audience_segment": F.col("_audience.segment"),
        }
    )
    return conform(stamped(typed, run_ts), target)


def campaign_events_from_raw(raw: DataFrame, run_ts: Column) -> DataFrame:
    target = tables.CAMPAIGN_EVENTS
    typed = raw.withColumns(
        {
            **_ids("event_id", "campaign_id", "customer_id"),
            **_typed(target, "attributed_revenue"),
            "event_timestamp": _moment("event_timestamp"),
        }
    ).withColumn("event_date", F.to_date("event_timestamp"))
    return conform(stamped(typed, run_ts), target)
