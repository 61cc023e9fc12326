"""Analytics marts.

Rates are percentages. Columns without any source in the model (foot traffic, email
opens, revenue targets and the like) stay in the schema and are NULL. Amounts and
growth rates are declared wide enough that totals of very large tables fit.
"""

from __future__ import annotations

from shelfmark.contracts import contract

# Column names and types of the gold tables.
CUSTOMER_360 = contract("customer_360", """
customer_key bigint
customer_id bigint
analysis_date date
customer_age bigint
customer_segment string
lifetime_stage string
first_purchase_date date
last_purchase_date date
total_orders bigint
total_items_purchased bigint
total_revenue decimal(20,2)
total_profit decimal(20,2)
avg_order_value decimal(20,2)
avg_items_per_order decimal(20,2)
orders_last_30d bigint
revenue_last_30d decimal(20,2)
orders_last_90d bigint
revenue_last_90d decimal(20,2)
orders_last_365d bigint
revenue_last_365d decimal(20,2)
unique_products_purchased_365d bigint
unique_categories_purchased_365d bigint
primary_channel string
channel_diversity_score decimal(20,2)
online_order_percentage decimal(20,2)
mobile_order_percentage decimal(20,2)
instore_order_percentage decimal(20,2)
most_purchased_category string
most_purchased_brand string
avg_price_point decimal(20,2)
premium_product_percentage decimal(20,2)
loyalty_tier string
total_loyalty_points_earned bigint
total_loyalty_points_redeemed bigint
loyalty_points_balance bigint
has_active_subscription boolean
subscription_count bigint
subscription_mrr decimal(20,2)
days_since_last_purchase bigint
purchase_frequency_days decimal(20,2)
recency_score bigint
frequency_score bigint
monetary_score bigint
rfm_segment string
total_support_interactions bigint
avg_satisfaction_rating decimal(20,2)
unresolved_issues_count bigint
total_returns bigint
return_rate decimal(20,2)
total_return_value decimal(20,2)
orders_with_discount bigint
discount_usage_rate decimal(20,2)
avg_discount_percentage decimal(20,2)
clv_prediction decimal(20,2)
churn_probability decimal(20,2)
next_purchase_probability decimal(20,2)
predicted_next_purchase_date date
campaign_response_rate decimal(20,2)
email_open_rate decimal(20,2)
email_click_rate decimal(20,2)
created_timestamp timestamp
updated_timestamp timestamp
""", "customer_id analysis_date", "analysis_date")

PRODUCT_PERFORMANCE = contract("product_performance", """
product_key bigint
product_id bigint
analysis_date date
time_period string
product_name string
category_level1 string
category_level2 string
brand string
total_units_sold bigint
total_transactions bigint
total_customers bigint
new_customers bigint
repeat_customers bigint
gross_revenue decimal(20,2)
net_revenue decimal(20,2)
total_discounts decimal(20,2)
avg_selling_price decimal(20,2)
avg_discount_percentage decimal(20,2)
total_cost decimal(20,2)
gross_profit decimal(20,2)
gross_margin_percentage decimal(20,2)
contribution_margin decimal(20,2)
units_returned bigint
return_rate decimal(20,2)
return_value decimal(20,2)
top_return_reason string
avg_inventory_on_hand decimal(20,2)
stockout_days bigint
stockout_rate decimal(20,2)
inventory_turnover decimal(20,2)
days_inventory_outstanding decimal(20,2)
units_per_day decimal(20,2)
revenue_per_day decimal(20,2)
sales_velocity_trend string
category_revenue_rank bigint
category_units_rank bigint
overall_revenue_rank bigint
category_market_share decimal(20,2)
penetration_rate decimal(20,2)
repeat_purchase_rate decimal(20,2)
avg_units_per_customer decimal(20,2)
price_elasticity_coefficient decimal(20,4)
optimal_price_point decimal(20,2)
basket_attachment_rate decimal(20,2)
avg_basket_size_with_product decimal(20,2)
top_cross_sell_products array<string>
revenue_growth_rate decimal(20,2)
volume_growth_rate decimal(20,2)
market_share_change decimal(20,2)
is_trending boolean
is_seasonal boolean
is_low_performer boolean
is_high_performer boolean
requires_reorder boolean
created_timestamp timestamp
""", "product_id analysis_date time_period", "analysis_date time_period")

COHORT_ANALYSIS = contract("cohort_analysis", """
cohort_month date
months_since_first_purchase bigint
cohort_size bigint
customers_active bigint
retention_rate decimal(20,2)
cumulative_retention_rate decimal(20,2)
churn_rate decimal(20,2)
cumulative_churn_rate decimal(20,2)
cohort_revenue decimal(20,2)
cumulative_cohort_revenue decimal(20,2)
avg_revenue_per_customer decimal(20,2)
cumulative_avg_revenue_per_customer decimal(20,2)
total_orders bigint
cumulative_orders bigint
avg_orders_per_customer decimal(20,2)
cumulative_avg_orders_per_customer decimal(20,2)
repeat_purchase_rate decimal(20,2)
avg_purchase_frequency decimal(20,2)
avg_days_between_purchases decimal(20,2)
avg_days_since_first decimal(20,2)
online_percentage decimal(20,2)
mobile_percentage decimal(20,2)
instore_percentage decimal(20,2)
marketplace_percentage decimal(20,2)
subscription_adoption_rate decimal(20,2)
avg_subscription_value decimal(20,2)
created_timestamp timestamp
""", "cohort_month months_since_first_purchase", "cohort_month")

CHANNEL_ATTRIBUTION = contract("channel_attribution", """
attribution_date date
customer_id bigint
transaction_id bigint
transaction_revenue decimal(20,2)
transaction_profit decimal(20,2)
first_touch_channel string
first_touch_campaign_id bigint
first_touch_attribution_revenue decimal(20,2)
last_touch_channel string
last_touch_campaign_id bigint
last_touch_attribution_revenue decimal(20,2)
touchpoint_count bigint
linear_attribution_per_touchpoint decimal(20,2)
time_decay_attribution_map map<string,decimal(20,2)>
position_based_attribution_map map<string,decimal(20,2)>
data_driven_attribution_map map<string,decimal(20,2)>
journey_length_days bigint
journey_touchpoints array<struct<channel:string,timestamp:timestamp,campaign_id:bigint,event_type:string>>
created_timestamp timestamp
""", "transaction_id", "attribution_month")

CATEGORY_BRAND_PERFORMANCE = contract("category_brand_performance", """
analysis_date date
time_period string
period_date date
category_level1 string
category_level2 string
category_level3 string
brand string
total_revenue decimal(20,2)
total_units_sold bigint
total_transactions bigint
unique_customers bigint
avg_transaction_value decimal(20,2)
avg_units_per_transaction decimal(20,2)
avg_price_point decimal(20,2)
total_profit decimal(20,2)
profit_margin_percentage decimal(20,2)
category_revenue_percentage decimal(20,2)
brand_revenue_percentage decimal(20,2)
revenue_growth_wow decimal(20,2)
revenue_growth_mom decimal(20,2)
revenue_growth_yoy decimal(20,2)
units_growth_yoy decimal(20,2)
customer_penetration_rate decimal(20,2)
new_customer_percentage decimal(20,2)
repeat_customer_rate decimal(20,2)
avg_discount_percentage decimal(20,2)
promotional_sales_percentage decimal(20,2)
price_index decimal(20,2)
revenue_rank_in_category bigint
units_rank_in_category bigint
growth_rank_in_category bigint
created_timestamp timestamp
""", "analysis_date time_period period_date category_level1 category_level2 category_level3 brand", "analysis_date time_period")

STORE_PERFORMANCE = contract("store_performance", """
analysis_date date
store_id bigint
store_name string
store_region string
store_tier string
daily_revenue decimal(20,2)
daily_transactions bigint
daily_customers bigint
avg_transaction_value decimal(20,2)
revenue_per_square_foot decimal(20,2)
foot_traffic bigint
conversion_rate decimal(20,2)
staff_count bigint
revenue_per_employee decimal(20,2)
inventory_value decimal(20,2)
stockout_rate decimal(20,2)
inventory_turnover decimal(20,2)
avg_satisfaction_rating decimal(20,2)
nps_score decimal(20,2)
revenue_vs_target decimal(20,2)
revenue_rank_in_region bigint
revenue_percentile decimal(20,2)
revenue_trend_7d string
revenue_growth_wow decimal(20,2)
revenue_growth_yoy decimal(20,2)
created_timestamp timestamp
""", "store_id analysis_date", "analysis_date")

SUBSCRIPTION_HEALTH = contract("subscription_health", """
analysis_date date
plan_id bigint
plan_name string
subscription_type string
billing_frequency string
active_subscribers bigint
new_subscribers_mtd bigint
cancelled_subscribers_mtd bigint
paused_subscribers bigint
net_subscriber_change bigint
mrr decimal(20,2)
arr decimal(20,2)
avg_revenue_per_subscriber decimal(20,2)
lifetime_value_avg decimal(20,2)
churn_rate_monthly decimal(20,2)
churn_rate_annual decimal(20,2)
revenue_churn_rate decimal(20,2)
reactivation_rate decimal(20,2)
retention_rate_30d decimal(20,2)
retention_rate_90d decimal(20,2)
retention_rate_365d decimal(20,2)
cohort_0_3_months_retention decimal(20,2)
cohort_3_6_months_retention decimal(20,2)
cohort_6_12_months_retention decimal(20,2)
cohort_12plus_months_retention decimal(20,2)
avg_subscription_duration_days decimal(20,2)
avg_payments_before_churn decimal(20,2)
subscriber_growth_rate decimal(20,2)
mrr_growth_rate decimal(20,2)
quick_ratio decimal(20,2)
top_cancellation_reason string
avg_days_to_cancel decimal(20,2)
voluntary_churn_rate decimal(20,2)
involuntary_churn_rate decimal(20,2)
created_timestamp timestamp
""", "plan_id analysis_date", "analysis_date")

BASKET_ANALYSIS = contract("basket_analysis", """
analysis_date date
product_id_a bigint
product_id_b bigint
product_name_a string
product_name_b string
category_a string
category_b string
transactions_with_a bigint
transactions_with_b bigint
transactions_with_both bigint
total_transactions bigint
support double
confidence_a_to_b double
confidence_b_to_a double
lift double
conviction double
avg_basket_value_with_both decimal(20,2)
avg_basket_value_with_a_only decimal(20,2)
incremental_basket_value decimal(20,2)
recommendation_score decimal(20,2)
is_strong_association boolean
created_timestamp timestamp
""", "analysis_date product_id_a product_id_b", "analysis_date")

CAMPAIGN_ROI_ANALYSIS = contract("campaign_roi_analysis", """
analysis_date date
campaign_id bigint
coupon_code string
campaign_name string
campaign_type string
channel string
start_date date
end_date date
campaign_duration_days bigint
total_budget decimal(20,2)
actual_spend decimal(20,2)
budget_utilization_rate decimal(20,2)
total_impressions bigint
total_clicks bigint
total_conversions bigint
unique_customers_reached bigint
click_through_rate decimal(20,2)
conversion_rate decimal(20,2)
attributed_revenue decimal(20,2)
attributed_transactions bigint
new_customer_revenue decimal(20,2)
existing_customer_revenue decimal(20,2)
attributed_profit decimal(20,2)
cost_per_impression decimal(20,4)
cost_per_click decimal(20,2)
cost_per_acquisition decimal(20,2)
roi_percentage decimal(20,2)
roas decimal(20,2)
incremental_revenue decimal(20,2)
incremental_profit decimal(20,2)
avg_clv_of_acquired_customers decimal(20,2)
estimated_lifetime_roi decimal(20,2)
revenue_per_impression decimal(20,4)
profit_per_dollar_spent decimal(20,2)
roi_vs_channel_avg decimal(20,2)
performance_rank_in_channel bigint
created_timestamp timestamp
""", "analysis_date coupon_code channel", "analysis_date")

GOLD = {
    table.name: table
    for table in (
        CUSTOMER_360,
        PRODUCT_PERFORMANCE,
        COHORT_ANALYSIS,
        CHANNEL_ATTRIBUTION,
        CATEGORY_BRAND_PERFORMANCE,
        STORE_PERFORMANCE,
        SUBSCRIPTION_HEALTH,
        BASKET_ANALYSIS,
        CAMPAIGN_ROI_ANALYSIS,
    )
}
