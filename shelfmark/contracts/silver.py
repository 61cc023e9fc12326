"""Typed and enriched tables."""

from __future__ import annotations

from shelfmark.contracts import contract

# Column names and types of the silver tables.
TRANSACTIONS = contract("transactions", """
transaction_id bigint
customer_id bigint
transaction_timestamp timestamp
transaction_date date
channel string
store_id bigint
payment_method string
payment_status string
subtotal decimal(12,2)
tax_amount decimal(12,2)
shipping_cost decimal(12,2)
discount_amount decimal(12,2)
total_amount decimal(12,2)
currency string
loyalty_points_earned int
loyalty_points_redeemed int
coupon_codes array<string>
transaction_year int
transaction_month int
transaction_quarter int
transaction_day_of_week int
transaction_hour int
is_weekend boolean
is_holiday boolean
fiscal_year int
fiscal_quarter int
is_first_purchase boolean
is_return_transaction boolean
has_discount boolean
has_coupon boolean
source_system string
created_timestamp timestamp
updated_timestamp timestamp
""", "transaction_id", "transaction_year transaction_month")

TRANSACTION_ITEMS = contract("transaction_items", """
transaction_item_id bigint
transaction_id bigint
product_id bigint
variant_id bigint
quantity int
return_quantity int
net_quantity int
unit_price decimal(10,2)
unit_cost decimal(10,2)
discount_percentage decimal(5,2)
tax_rate decimal(5,4)
line_subtotal decimal(12,2)
line_discount decimal(12,2)
line_tax decimal(12,2)
line_total decimal(12,2)
line_cost decimal(12,2)
line_profit decimal(12,2)
line_margin_percentage decimal(12,2)
net_line_revenue decimal(12,2)
return_reason string
fulfillment_status string
warehouse_id bigint
location_type string
source_system string
created_timestamp timestamp
updated_timestamp timestamp
""", "transaction_item_id", "order_month")

SUBSCRIPTIONS = contract("subscriptions", """
subscription_id bigint
customer_id bigint
subscription_type string
plan_id bigint
start_date date
end_date date
cancellation_date date
next_billing_date date
status string
billing_frequency string
auto_renewal boolean
cancellation_reason string
subscription_amount decimal(10,2)
subscription_duration_days int
total_payments_made int
lifetime_value decimal(12,2)
is_churned boolean
churn_risk_score decimal(3,2)
effective_start_date timestamp
effective_end_date timestamp
is_current boolean
source_system string
created_timestamp timestamp
updated_timestamp timestamp
""", "subscription_id", "is_current")

CUSTOMER_INTERACTIONS = contract("customer_interactions", """
interaction_id bigint
customer_id bigint
interaction_timestamp timestamp
interaction_date date
interaction_type string
channel string
agent_id bigint
category string
subcategory string
sentiment_score decimal(3,2)
resolution_time_minutes int
satisfaction_rating int
interaction_year int
interaction_month int
is_resolved boolean
is_escalated boolean
source_system string
created_timestamp timestamp
""", "interaction_id", "interaction_year interaction_month")

PRODUCT_CATALOG = contract("product_catalog", """
product_id bigint
product_name string
category_level1 string
category_level2 string
category_level3 string
full_category_path string
brand string
manufacturer string
unit_cost decimal(10,2)
list_price decimal(10,2)
margin_percentage decimal(12,2)
price_tier string
supplier_id bigint
lead_time_days int
weight_kg decimal(8,3)
launch_date date
discontinuation_date date
is_active boolean
product_age_days int
lifecycle_stage string
tags array<string>
effective_start_date timestamp
effective_end_date timestamp
is_current boolean
source_system string
created_timestamp timestamp
updated_timestamp timestamp
""", "product_id", "is_current")

INVENTORY_SNAPSHOTS = contract("inventory_snapshots", """
snapshot_id bigint
snapshot_timestamp timestamp
snapshot_date date
product_id bigint
variant_id bigint
warehouse_id bigint
quantity_on_hand int
quantity_reserved int
quantity_available int
reorder_point int
reorder_quantity int
days_of_supply int
stock_status string
is_stockout boolean
stockout_duration_days int
source_system string
created_timestamp timestamp
""", "snapshot_id", "snapshot_date")

MARKETING_CAMPAIGNS = contract("marketing_campaigns", """
campaign_id bigint
campaign_name string
campaign_type string
channel string
start_date date
end_date date
duration_days int
budget decimal(12,2)
audience_age_range string
audience_interests array<string>
audience_segment string
creative_id bigint
source_system string
created_timestamp timestamp
""", "campaign_id")

CAMPAIGN_EVENTS = contract("campaign_events", """
event_id bigint
campaign_id bigint
customer_id bigint
event_timestamp timestamp
event_date date
event_type string
device_type string
location string
attributed_revenue decimal(12,2)
source_system string
created_timestamp timestamp
""", "event_id", "event_date")

SILVER = {
    table.name: table
    for table in (
        TRANSACTIONS, TRANSACTION_ITEMS, SUBSCRIPTIONS, CUSTOMER_INTERACTIONS, PRODUCT_CATALOG,
        INVENTORY_SNAPSHOTS, MARKETING_CAMPAIGNS, CAMPAIGN_EVENTS,
    )
}
