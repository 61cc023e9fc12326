"""Raw feeds: every business column is text, followed by four audit columns."""

from __future__ import annotations

from shelfmark.contracts import Contract

# Column names of the raw feeds.
FEED_COLUMNS = {
    "transactions_raw": """transaction_id customer_id transaction_timestamp channel store_id payment_method
        payment_status subtotal tax_amount shipping_cost discount_amount total_amount currency
        loyalty_points_earned loyalty_points_redeemed coupon_codes""",
    "transaction_items_raw": """transaction_item_id transaction_id product_id variant_id quantity unit_price
        discount_percentage tax_rate return_quantity return_reason fulfillment_status warehouse_id""",
    "subscriptions_raw": """subscription_id customer_id subscription_type plan_id start_date end_date status
        billing_frequency subscription_amount next_billing_date auto_renewal cancellation_date
        cancellation_reason""",
    "customer_interactions_raw": """interaction_id customer_id interaction_timestamp interaction_type channel
        agent_id category subcategory sentiment_score resolution_time_minutes satisfaction_rating notes""",
    "product_catalog_raw": """product_id product_name category_level1 category_level2 category_level3 brand
        manufacturer unit_cost list_price margin_percentage supplier_id lead_time_days weight_kg dimensions
        tags launch_date discontinuation_date""",
    "inventory_snapshots_raw": """snapshot_id snapshot_timestamp product_id variant_id warehouse_id
        quantity_on_hand quantity_reserved quantity_available reorder_point reorder_quantity""",
    "marketing_campaigns_raw": """campaign_id campaign_name campaign_type channel start_date end_date budget
        target_audience creative_id""",
    "campaign_events_raw": """event_id campaign_id customer_id event_timestamp event_type device_type location
        attributed_revenue""",
}

AUDIT_FIELDS = (
    ("_source_system", "string"),
    ("_ingestion_timestamp", "timestamp"),
    ("_file_name", "string"),
    ("_record_offset", "bigint"),
)

# Small dimensions stay in one directory; facts are split by the day they arrived.
DIMENSION_FEEDS = {"product_catalog_raw", "marketing_campaigns_raw"}


def _feed(name: str, columns: str) -> Contract:
    names = columns.split()
    fields = tuple((column, "string") for column in names) + AUDIT_FIELDS
    day = () if name in DIMENSION_FEEDS else ("_ingestion_date",)
    return Contract(name, fields, (names[0],), day)


BRONZE = {name: _feed(name, columns) for name, columns in FEED_COLUMNS.items()}
