"""Oracle statements for customers, cohorts, stores and subscriptions."""

from __future__ import annotations


from oracle.sql import D, G, M, MEAN, N, P, R
from oracle.views import ORDERS_AS_OF as AS_OF

ZERO = "CAST(0 AS DECIMAL(12,2))"

BASE = f"""
SELECT *, {AS_OF} - last_purchase_date AS days_since_last_purchase,
  {R(f"{AS_OF} - first_purchase_date", "total_orders")} AS purchase_frequency_days,
  {P("orders_with_discount", "total_orders")} AS discount_usage_rate
FROM (SELECT customer_id, MIN(transaction_date) AS first_purchase_date, MAX(transaction_date) AS last_purchase_date,
  COUNT(*) AS total_orders, {M("SUM(total_amount)")} AS total_revenue, {MEAN("total_amount")} AS avg_order_value,
  COUNT(*) FILTER (has_discount) AS orders_with_discount,
  {MEAN(f"CASE WHEN has_discount THEN CAST({P('discount_amount', 'subtotal')} AS DECIMAL(18,6)) ELSE CAST(0 AS DECIMAL(18,6)) END")}
    AS avg_discount_percentage
FROM txn GROUP BY customer_id)"""

MIX = "SELECT customer_id, COUNT(*) AS total_orders, " + ", ".join(
    f"COUNT(*) FILTER (channel = '{c}') AS {n}_orders"
    for c, n in (("online", "online"), ("mobile", "mobile"), ("in-store", "instore"), ("marketplace", "marketplace"))
) + ", COUNT(DISTINCT channel) AS used FROM txn GROUP BY customer_id"

MIX_FULL = "SELECT * EXCLUDE (used), " + ", ".join(
    f"{P(f'{n}_orders', 'total_orders')} AS {n}_order_percentage" for n in ("online", "mobile", "instore", "marketplace")
) + f", {R('used', '4')} AS channel_diversity_score FROM ({MIX})"

RECENT = "SELECT customer_id, " + ", ".join(
    f"COUNT(*) FILTER (transaction_date > {AS_OF} - {d} AND transaction_date <= {AS_OF}) AS orders_last_{d}d, "
    + M(f"SUM(CASE WHEN transaction_date > {AS_OF} - {d} AND transaction_date <= {AS_OF} THEN total_amount ELSE {ZERO} END)")
    + f" AS revenue_last_{d}d"
    for d in (30, 90, 365)
) + " FROM txn GROUP BY customer_id"

RFM = f"""
SELECT *, ntile(5) OVER (ORDER BY days_since_last_purchase DESC, customer_id) AS recency_score,
  ntile(5) OVER (ORDER BY total_orders, customer_id) AS frequency_score,
  ntile(5) OVER (ORDER BY total_revenue, customer_id) AS monetary_score FROM ({BASE})"""

SEGMENT = f"""
SELECT *, CASE WHEN recency_score >= 4 AND frequency_score >= 4 THEN 'Champions'
  WHEN recency_score >= 3 AND frequency_score >= 3 THEN 'Loyal Customers'
  WHEN days_since_last_purchase > 180 THEN 'At Risk' ELSE 'Regular Customers' END AS rfm_segment FROM ({RFM})"""

PREDICTED = """
SELECT *, CAST(total_revenue * CAST(1.5 AS DECIMAL(2,1)) AS DECIMAL(20,2)) AS clv_prediction,
  CAST(CASE WHEN days_since_last_purchase > 180 THEN 0.8 WHEN days_since_last_purchase > 90 THEN 0.5 ELSE 0.2 END
    AS DECIMAL(3,2)) AS churn_probability,
  CASE WHEN total_orders = 1 THEN 'new' WHEN days_since_last_purchase > 365 THEN 'churned'
    WHEN days_since_last_purchase > 180 THEN 'at_risk' ELSE 'active' END AS lifetime_stage FROM ({})"""

BOUGHT = """
SELECT customer_id, item.*, transaction_date FROM item JOIN txn USING (transaction_id)"""

ITEMS = f"""
SELECT customer_id, {N("SUM(net_quantity)")} AS total_items_purchased, COUNT(DISTINCT b.product_id) AS unique_products,
  COUNT(DISTINCT category_level1) AS unique_categories, COUNT(DISTINCT brand) AS unique_brands,
  COUNT(DISTINCT CASE WHEN transaction_date > {AS_OF} - 365 THEN b.product_id END) AS unique_products_purchased_365d,
  COUNT(DISTINCT CASE WHEN transaction_date > {AS_OF} - 365 THEN category_level1 END) AS unique_categories_purchased_365d,
  {R("SUM(unit_price * quantity)", "SUM(quantity)")} AS avg_price_point,
  {P("SUM(CASE WHEN price_tier IN ('premium', 'luxury') THEN quantity ELSE 0 END)", "SUM(quantity)")}
    AS premium_product_percentage,
  COUNT(*) FILTER (return_quantity > 0) AS total_returns, {P("SUM(return_quantity)", "SUM(quantity)")} AS return_rate,
  {M("SUM(return_quantity * unit_price)")} AS total_return_value, {M("SUM(net_line_revenue - line_cost)")} AS total_profit
FROM ({BOUGHT}) b LEFT JOIN product ON b.product_id = product.product_id GROUP BY customer_id"""


def top(value: str, name: str) -> str:
    return f"""SELECT customer_id, {value} AS {name} FROM (SELECT customer_id, {value}, SUM(net_quantity) AS w
FROM ({BOUGHT}) b JOIN product ON b.product_id = product.product_id GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY w DESC, {value}) = 1"""


FAVOURITE = f"""
SELECT customer_id, most_purchased_category, most_purchased_brand
FROM ({top("category_level1", "most_purchased_category")}) JOIN ({top("brand", "most_purchased_brand")}) USING (customer_id)"""

PRIMARY = f"""
SELECT customer_id, primary_channel, channel_diversity_score FROM (SELECT customer_id, channel AS primary_channel
FROM (SELECT customer_id, channel, COUNT(*) AS w FROM txn GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY w DESC, channel) = 1) JOIN ({MIX_FULL}) USING (customer_id)"""

LOYALTY = """
SELECT *, total_loyalty_points_earned - total_loyalty_points_redeemed AS loyalty_points_balance,
  CASE WHEN total_loyalty_points_earned >= 10000 THEN 'platinum' WHEN total_loyalty_points_earned >= 5000 THEN 'gold'
    WHEN total_loyalty_points_earned >= 1000 THEN 'silver' ELSE 'bronze' END AS loyalty_tier
FROM (SELECT customer_id, CAST(SUM(loyalty_points_earned) AS BIGINT) AS total_loyalty_points_earned,
  CAST(SUM(loyalty_points_redeemed) AS BIGINT) AS total_loyalty_points_redeemed FROM txn GROUP BY 1)"""

# Amount per month with six digits: cents * 10^4 over 1, 3 or 12 in whole numbers, rounded half up.
PER_MONTH = """CAST(CASE billing_frequency WHEN 'monthly' THEN CAST(subscription_amount * 1000000 AS BIGINT)
  WHEN 'quarterly' THEN (CAST(subscription_amount * 1000000 AS BIGINT) * 2 + 3) // 6
  ELSE (CAST(subscription_amount * 1000000 AS BIGINT) * 2 + 12) // 24 END AS DECIMAL(28,0)) * CAST(0.000001 AS DECIMAL(7,6))"""

SUBS = f"""
SELECT customer_id, COUNT(*) FILTER (status = 'active') > 0 AS has_active_subscription, COUNT(*) AS subscription_count,
  {M(f"COALESCE(SUM(CASE WHEN status = 'active' THEN {PER_MONTH} END), 0)")} AS subscription_mrr
FROM sub GROUP BY customer_id"""

SUPPORT = f"""
SELECT customer_id, COUNT(*) AS total_support_interactions, {MEAN("satisfaction_rating")} AS avg_satisfaction_rating,
  COUNT(*) FILTER (NOT is_resolved) AS unresolved_issues_count FROM talk GROUP BY customer_id"""

KEYED = f"SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_key FROM ({PREDICTED.format(SEGMENT)})"

C360 = f"""
WITH k AS ({KEYED}), mix AS ({MIX_FULL}), rec AS ({RECENT}), it AS ({ITEMS}), fav AS ({FAVOURITE}), pri AS ({PRIMARY}),
  loy AS ({LOYALTY}), sb AS ({SUBS}), su AS ({SUPPORT})
SELECT customer_key, k.customer_id, {AS_OF} AS analysis_date, CAST(NULL AS INTEGER) AS customer_age,
  rfm_segment AS customer_segment, lifetime_stage, first_purchase_date, last_purchase_date, k.total_orders,
  COALESCE(total_items_purchased, 0) AS total_items_purchased, total_revenue, total_profit,
  {D("avg_order_value", 10, 2)} AS avg_order_value,
  {D(R("COALESCE(total_items_purchased, 0)", "k.total_orders"), 12, 2)} AS avg_items_per_order,
  rec.* EXCLUDE (customer_id), unique_products_purchased_365d, unique_categories_purchased_365d, primary_channel,
  {D("pri.channel_diversity_score", 3, 2)} AS channel_diversity_score,
  {D("online_order_percentage", 5, 2)} AS online_order_percentage,
  {D("mobile_order_percentage", 5, 2)} AS mobile_order_percentage,
  {D("instore_order_percentage", 5, 2)} AS instore_order_percentage,
  most_purchased_category, most_purchased_brand, {D("avg_price_point", 10, 2)} AS avg_price_point,
  {D("premium_product_percentage", 5, 2)} AS premium_product_percentage, loyalty_tier,
  total_loyalty_points_earned, total_loyalty_points_redeemed, loyalty_points_balance,
  COALESCE(has_active_subscription, FALSE) AS has_active_subscription, COALESCE(subscription_count, 0) AS subscription_count,
  COALESCE(subscription_mrr, 0) AS subscription_mrr, days_since_last_purchase,
  {D("purchase_frequency_days", 12, 2)} AS purchase_frequency_days, recency_score, frequency_score, monetary_score,
  rfm_segment, COALESCE(total_support_interactions, 0) AS total_support_interactions,
  {D("avg_satisfaction_rating", 3, 2)} AS avg_satisfaction_rating,
  COALESCE(unresolved_issues_count, 0) AS unresolved_issues_count, COALESCE(total_returns, 0) AS total_returns,
  {D("return_rate", 5, 2)} AS return_rate, total_return_value, orders_with_discount,
  {D("discount_usage_rate", 5, 2)} AS discount_usage_rate, {D("avg_discount_percentage", 5, 2)} AS avg_discount_percentage,
  clv_prediction, churn_probability, CAST(1 - churn_probability AS DECIMAL(3,2)) AS next_purchase_probability,
  last_purchase_date + CAST(ROUND(purchase_frequency_days) AS INTEGER) AS predicted_next_purchase_date,
  CAST(NULL AS DECIMAL(5,2)) AS campaign_response_rate, CAST(NULL AS DECIMAL(5,2)) AS email_open_rate,
  CAST(NULL AS DECIMAL(5,2)) AS email_click_rate
FROM k LEFT JOIN mix USING (customer_id) LEFT JOIN rec USING (customer_id) LEFT JOIN it USING (customer_id)
  LEFT JOIN fav USING (customer_id) LEFT JOIN pri USING (customer_id) LEFT JOIN loy USING (customer_id)
  LEFT JOIN sb USING (customer_id) LEFT JOIN su USING (customer_id)"""

# --- cohorts ---

FIRST = """SELECT customer_id, MIN(transaction_date) AS first_purchase_date,
  CAST(date_trunc('month', MIN(transaction_date)) AS DATE) AS cohort_month FROM txn GROUP BY 1"""

ASSIGNED = f"""SELECT txn.*, first_purchase_date, cohort_month,
  date_diff('month', cohort_month, CAST(date_trunc('month', transaction_date) AS DATE)) AS o,
  transaction_date - lag(transaction_date) OVER (PARTITION BY customer_id ORDER BY transaction_date, transaction_id) AS gap
FROM txn JOIN ({FIRST}) USING (customer_id)"""

CHANNELS = (("online", "online"), ("mobile", "mobile"), ("in-store", "instore"), ("marketplace", "marketplace"))

PERIODS = f"""SELECT cohort_month, o AS months_since_first_purchase, COUNT(DISTINCT customer_id) AS customers_active,
  COUNT(*) AS total_orders, {M("SUM(total_amount)")} AS cohort_revenue,
  {", ".join(f"COUNT(DISTINCT CASE WHEN channel = '{c}' THEN customer_id END) AS {n}_customers" for c, n in CHANNELS)},
  {R("SUM(gap)", "COUNT(gap)")} AS avg_days_between_purchases,
  {R("SUM(transaction_date - first_purchase_date)", "COUNT(*)")} AS avg_days_since_first
FROM ({ASSIGNED}) GROUP BY 1, 2"""

REPEAT = f"""SELECT cohort_month, o AS months_since_first_purchase, COUNT(*) AS repeat_customers_count FROM (
  SELECT cohort_month, o, customer_id FROM ({ASSIGNED}) GROUP BY ALL HAVING COUNT(*) > 1) GROUP BY 1, 2"""

COHORT = f"""
SELECT *, {P("customers_active", "cohort_size")} AS retention_rate,
  ROUND(100 - {P("customers_active", "cohort_size")}, 6) AS churn_rate,
  {R("cohort_revenue", "customers_active")} AS avg_revenue_per_customer,
  {R("total_orders", "customers_active")} AS avg_orders_per_customer,
  {R("total_orders", "customers_active")} AS avg_purchase_frequency,
  {P("repeat_customers_count", "customers_active")} AS repeat_purchase_rate,
  {", ".join(f"{P(f'{n}_customers', 'customers_active')} AS {n}_percentage" for _, n in CHANNELS)},
  {P("run_active", "cohort_size * run_n")} AS cumulative_retention_rate,
  ROUND(100 - {P("run_active", "cohort_size * run_n")}, 6) AS cumulative_churn_rate,
  {R("cumulative_cohort_revenue", "cohort_size")} AS cumulative_avg_revenue_per_customer,
  {R("cumulative_orders", "cohort_size")} AS cumulative_avg_orders_per_customer
FROM (SELECT p.*, COALESCE(repeat_customers_count, 0) AS repeat_customers_count,
  MAX(CASE WHEN months_since_first_purchase = 0 THEN customers_active END) OVER (PARTITION BY cohort_month) AS cohort_size,
  {N("SUM(total_orders) OVER w")} AS cumulative_orders, {M("SUM(cohort_revenue) OVER w")} AS cumulative_cohort_revenue,
  SUM(customers_active) OVER w AS run_active, COUNT(*) OVER w AS run_n
FROM ({PERIODS}) p LEFT JOIN ({REPEAT}) USING (cohort_month, months_since_first_purchase)
WINDOW w AS (PARTITION BY cohort_month ORDER BY months_since_first_purchase ROWS UNBOUNDED PRECEDING))"""

ADOPTION = f"""SELECT cohort_month, date_diff('month', cohort_month, CAST(date_trunc('month', start_date) AS DATE))
  AS months_since_first_purchase, COUNT(DISTINCT customer_id) AS subscribers,
  {MEAN("subscription_amount")} AS avg_subscription_value FROM sub JOIN ({FIRST}) USING (customer_id) GROUP BY 1, 2"""

COHORT_FULL = f"""SELECT c.*, {P("COALESCE(subscribers, 0)", "customers_active")} AS subscription_adoption_rate,
  COALESCE(avg_subscription_value, 0.0) AS avg_subscription_value
FROM ({COHORT}) c LEFT JOIN ({ADOPTION}) USING (cohort_month, months_since_first_purchase)"""


def pct(name: str) -> str:
    return f"{D(name, 5, 2)} AS {name}"


GOLD_COHORT = f"""SELECT cohort_month, months_since_first_purchase, cohort_size, customers_active, {pct("retention_rate")},
  {pct("cumulative_retention_rate")}, {pct("churn_rate")}, {pct("cumulative_churn_rate")}, cohort_revenue,
  cumulative_cohort_revenue, {D("avg_revenue_per_customer", 10, 2)} AS avg_revenue_per_customer,
  {D("cumulative_avg_revenue_per_customer", 10, 2)} AS cumulative_avg_revenue_per_customer, total_orders, cumulative_orders,
  {D("avg_orders_per_customer", 12, 2)} AS avg_orders_per_customer,
  {D("cumulative_avg_orders_per_customer", 12, 2)} AS cumulative_avg_orders_per_customer, {pct("repeat_purchase_rate")},
  {D("avg_purchase_frequency", 12, 2)} AS avg_purchase_frequency,
  {D("avg_days_between_purchases", 12, 2)} AS avg_days_between_purchases,
  {D("avg_days_since_first", 10, 2)} AS avg_days_since_first,
  {", ".join(pct(f"{n}_percentage") for _, n in CHANNELS)}, {pct("subscription_adoption_rate")},
  {D("avg_subscription_value", 10, 2)} AS avg_subscription_value FROM ({COHORT_FULL})"""

# --- stores ---


def store_base(by: str) -> str:
    extra = f", {by}" if by else ""
    over = f"PARTITION BY {by}" if by else ""
    return f"""SELECT *, dense_rank() OVER (PARTITION BY store_region{extra} ORDER BY daily_revenue DESC NULLS LAST)
    AS revenue_rank_in_region,
  ROUND(percent_rank() OVER ({over} ORDER BY daily_revenue ASC NULLS FIRST) * 100, 6) AS revenue_percentile
FROM (SELECT store_id{extra}, COUNT(*) AS daily_transactions, COUNT(DISTINCT customer_id) AS daily_customers,
  {M("SUM(total_amount)")} AS daily_revenue, {MEAN("total_amount")} AS avg_transaction_value FROM txn GROUP BY ALL)
LEFT JOIN store USING (store_id)"""


DAILY = f"""
WITH s AS ({store_base("transaction_date")})
SELECT s.*, {G("s.daily_revenue", "w.daily_revenue")} AS revenue_growth_wow,
  {G("s.daily_revenue", "y.daily_revenue")} AS revenue_growth_yoy,
  CASE WHEN r > e * 1.1::DOUBLE THEN 'up' WHEN r < e * 0.9::DOUBLE THEN 'down' ELSE 'stable' END AS revenue_trend_7d
FROM s LEFT JOIN s w ON s.store_id = w.store_id AND w.transaction_date = s.transaction_date - 7
LEFT JOIN s y ON s.store_id = y.store_id AND y.transaction_date = s.transaction_date - 365
LEFT JOIN (SELECT a.store_id, a.transaction_date,
  CAST(COALESCE(SUM(CASE WHEN a.transaction_date - b.transaction_date <= 6 THEN b.daily_revenue END), 0) AS DOUBLE) AS r,
  CAST(COALESCE(SUM(CASE WHEN a.transaction_date - b.transaction_date >= 7 THEN b.daily_revenue END), 0) AS DOUBLE) AS e
  FROM s a JOIN s b ON a.store_id = b.store_id AND b.transaction_date BETWEEN a.transaction_date - 13 AND a.transaction_date
  GROUP BY 1, 2) t ON t.store_id = s.store_id AND t.transaction_date = s.transaction_date"""


def nulls(kind: str, *names: str) -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name in names)


STORE_COLUMNS = f"""store_id, store_name, store_region, daily_revenue, daily_transactions,
  daily_customers, {D("avg_transaction_value", 10, 2)} AS avg_transaction_value, revenue_rank_in_region,
  {D("revenue_percentile", 5, 2)} AS revenue_percentile, {nulls("VARCHAR", "store_tier")}, {nulls("INTEGER", "foot_traffic", "staff_count")},
  {nulls("DECIMAL(10,2)", "revenue_per_square_foot", "conversion_rate", "revenue_per_employee", "inventory_value",
         "stockout_rate", "inventory_turnover", "avg_satisfaction_rating", "nps_score", "revenue_vs_target")}"""
GOLD_STORE = f"""SELECT transaction_date AS analysis_date, {STORE_COLUMNS}, revenue_trend_7d,
  {D("revenue_growth_wow", 12, 2)} AS revenue_growth_wow, {D("revenue_growth_yoy", 12, 2)} AS revenue_growth_yoy FROM ({DAILY})"""
STORE_SNAPSHOT = f"""SELECT {AS_OF} AS analysis_date, {STORE_COLUMNS} FROM ({store_base("")})"""

# --- subscriptions ---

M0, M1 = "DATE '2001-08-01'", "DATE '2001-07-01'"
YEAR = "DATE '2000-08-02'"

FLAGS = f"""
SELECT *, COALESCE(start_date >= {M0} AND start_date <= {AS_OF}, FALSE) AS opened,
  COALESCE(gone >= {M0} AND gone <= {AS_OF}, FALSE) AS lft,
  start_date < {M0} AND (gone IS NULL OR gone >= {M0}) AS at_start,
  start_date < {M1} AND (gone IS NULL OR gone >= {M1}) AS at_previous,
  COALESCE(gone > {YEAR} AND gone <= {AS_OF}, FALSE) AS left_year,
  start_date < {YEAR} AND (gone IS NULL OR gone >= {YEAR}) AS open_year_ago,
  (CASE WHEN is_churned THEN gone ELSE {AS_OF} END) - start_date AS held, {AS_OF} - start_date AS age,
  CAST(floor(((CASE WHEN is_churned THEN gone ELSE {AS_OF} END) - start_date) / 30.0) AS INTEGER) AS tenure
FROM (SELECT *, COALESCE(cancellation_date, CASE WHEN is_churned THEN end_date END) AS gone FROM sub)"""


def cnt(where: str) -> str:
    return f"COUNT(*) FILTER ({where})"


def amt(where: str) -> str:
    return f"CAST(COALESCE(SUM(CASE WHEN {where} THEN subscription_amount END), 0) AS DECIMAL(18,2))"


BANDS = {"0_3": "tenure >= 0 AND tenure < 3", "3_6": "tenure >= 3 AND tenure < 6", "6_12": "tenure >= 6 AND tenure < 12",
         "12plus": "tenure >= 12"}

HEALTH = f"""
WITH f AS ({FLAGS}),
g AS (SELECT plan_id, {cnt("status = 'active'")} AS active_subscribers, {cnt("opened")} AS new_subscribers_mtd,
  {cnt("lft")} AS cancelled_subscribers_mtd, {cnt("status = 'paused'")} AS paused_subscribers,
  {amt("status = 'active'")} AS mrr, {MEAN("subscription_amount", "status = 'active'")} AS avg_revenue_per_subscriber,
  {MEAN("lifetime_value", "status = 'active'")} AS lifetime_value_avg,
  {P(cnt("lft AND at_start"), cnt("at_start"))} AS churn_rate_monthly,
  {P(cnt("left_year AND open_year_ago"), cnt("open_year_ago"))} AS churn_rate_annual,
  {amt("lft AND at_start")} AS la, {amt("opened")} AS na, {amt("at_start")} AS sa, {amt("at_previous")} AS pa,
  {cnt("at_start")} AS sn, {cnt("at_previous")} AS pn,
  {", ".join(f"{P(cnt(f'age >= {d} AND held >= {d}'), cnt(f'age >= {d}'))} AS retention_rate_{d}d" for d in (30, 90, 365))},
  {", ".join(f"{P(cnt(f'{w} AND NOT is_churned'), cnt(w))} AS cohort_{n}_months_retention" for n, w in BANDS.items())},
  {MEAN("subscription_duration_days")} AS avg_subscription_duration_days,
  {MEAN("total_payments_made", "is_churned")} AS avg_payments_before_churn,
  {MEAN("cancellation_date - start_date", "cancellation_date IS NOT NULL")} AS avg_days_to_cancel,
  {P(cnt("is_churned AND COALESCE(cancellation_reason, '') NOT IN ('payment_failed', 'card_expired')"), "COUNT(*)")}
    AS voluntary_churn_rate,
  {P(cnt("is_churned AND COALESCE(cancellation_reason, '') IN ('payment_failed', 'card_expired')"), "COUNT(*)")}
    AS involuntary_churn_rate
  FROM f GROUP BY plan_id),
t AS (SELECT plan_id, cancellation_reason AS top_cancellation_reason FROM (SELECT plan_id, cancellation_reason, COUNT(*) AS n
  FROM sub WHERE cancellation_reason IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY plan_id ORDER BY n DESC, cancellation_reason) = 1)
SELECT g.* EXCLUDE (la, na, sa, pa, sn, pn), {AS_OF} AS analysis_date, CAST(plan_id AS VARCHAR) AS plan_name,
  new_subscribers_mtd - cancelled_subscribers_mtd AS net_subscriber_change, {M("mrr * 12", 20)} AS arr,
  {P("la", "sa")} AS revenue_churn_rate, {G("sn", "pn")} AS subscriber_growth_rate, {G("sa", "pa")} AS mrr_growth_rate,
  {R("na", "la")} AS quick_ratio, top_cancellation_reason
FROM g LEFT JOIN t USING (plan_id)"""


def d2(p: int, *names: str) -> str:
    return ", ".join(f"{D(name, p, 2)} AS {name}" for name in names)


_HEALTH_CTES, _HEALTH_BODY = HEALTH.rsplit("\nSELECT g.*", 1)
GOLD_HEALTH = f"""{_HEALTH_CTES}
SELECT analysis_date, plan_id, plan_name, {nulls("VARCHAR", "subscription_type", "billing_frequency")}, active_subscribers,
  new_subscribers_mtd, cancelled_subscribers_mtd, paused_subscribers, net_subscriber_change, mrr, arr,
  {d2(10, "avg_revenue_per_subscriber", "avg_subscription_duration_days", "avg_days_to_cancel")},
  {d2(18, "lifetime_value_avg", "revenue_churn_rate", "avg_payments_before_churn", "subscriber_growth_rate",
      "mrr_growth_rate", "quick_ratio", "churn_rate_annual")},
  {d2(5, "churn_rate_monthly", "retention_rate_30d", "retention_rate_90d", "retention_rate_365d",
      "cohort_0_3_months_retention", "cohort_3_6_months_retention", "cohort_6_12_months_retention",
      "cohort_12plus_months_retention", "voluntary_churn_rate", "involuntary_churn_rate")},
  {nulls("DECIMAL(5,2)", "reactivation_rate")}, top_cancellation_reason
FROM (SELECT g.*{_HEALTH_BODY})"""

STATEMENTS = {
    "agg_basic": f"""
SELECT customer_id, COUNT(*) AS total_orders, {M("SUM(total_amount)")} AS total_revenue,
  {MEAN("total_amount")} AS avg_order_value, MIN(transaction_date) AS first_purchase_date,
  MAX(transaction_date) AS last_purchase_date FROM txn GROUP BY customer_id""",
    "agg_count_distinct": """
SELECT channel, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT store_id) AS stores,
  COUNT(DISTINCT transaction_date) AS days FROM txn GROUP BY channel""",
    "agg_conditional_distinct": "SELECT store_id, " + ", ".join(
        f"COUNT(DISTINCT CASE WHEN channel = '{c}' THEN customer_id END) AS {n}_customers" for c, n in CHANNELS[:3]
    ) + """, COUNT(DISTINCT CASE WHEN is_first_purchase THEN customer_id END) AS new_customers,
  COUNT(DISTINCT CASE WHEN NOT is_first_purchase THEN customer_id END) AS repeat_customers FROM txnf GROUP BY store_id""",
    "agg_conditional": f"""
SELECT plan_id, COUNT(*) FILTER (status = 'active') AS active_subscribers,
  {M("SUM(CASE WHEN status = 'active' THEN subscription_amount ELSE 0 END)")} AS mrr,
  {MEAN("lifetime_value", "status = 'active'")} AS lifetime_value_avg,
  {MEAN("churn_risk_score", "is_churned")} AS avg_churn_risk FROM sub GROUP BY plan_id""",
    "agg_two_level": f"""
SELECT channel, COUNT(*) AS customers, {MEAN("orders")} AS avg_orders, MAX(orders) AS max_orders,
  {MEAN("revenue")} AS avg_revenue, COUNT(*) FILTER (orders > 1) AS repeat_customers
FROM (SELECT channel, customer_id, COUNT(*) AS orders, SUM(total_amount) AS revenue FROM txn GROUP BY ALL) GROUP BY channel""",
    "customer_base_metrics": BASE,
    "channel_mix": MIX_FULL,
    "customer_recent_windows": RECENT,
    "rfm_scores": f"""SELECT customer_id, days_since_last_purchase, total_orders, total_revenue, recency_score, frequency_score,
  monetary_score FROM ({RFM})""",
    "rfm_segment": f"SELECT customer_id, recency_score, frequency_score, rfm_segment FROM ({SEGMENT})",
    "churn_clv_heuristics": f"SELECT customer_id, clv_prediction, churn_probability FROM ({PREDICTED.format(BASE)})",
    "lifetime_stage": f"""SELECT customer_id, total_orders, days_since_last_purchase, lifetime_stage
FROM ({PREDICTED.format(BASE)})""",
    "surrogate_keys": """SELECT customer_id, row_number() OVER (ORDER BY customer_id) AS customer_key
FROM (SELECT DISTINCT customer_id FROM txn)""",
    "customer_item_metrics": ITEMS,
    "premium_share": f"SELECT customer_id, premium_product_percentage FROM ({ITEMS})",
    "customer_returns": f"SELECT customer_id, total_returns, return_rate, total_return_value FROM ({ITEMS})",
    "favorite_category_brand": FAVOURITE,
    "primary_channel": PRIMARY,
    "loyalty_balance": LOYALTY,
    "customer_subscriptions": SUBS,
    "customer_support": SUPPORT,
    "gold_customer_360": C360,
    "cohort_assign": f"""SELECT transaction_id, customer_id, first_purchase_date, cohort_month,
  o AS months_since_first_purchase FROM ({ASSIGNED})""",
    "cohort_size": f"SELECT cohort_month, COUNT(*) AS cohort_size FROM ({FIRST}) GROUP BY 1",
    "cohort_size_distribution": f"SELECT cohort_month, COUNT(*) AS customers FROM ({FIRST}) GROUP BY 1 ORDER BY 1",
    "cohort_retention": f"""SELECT cohort_month, months_since_first_purchase, cohort_size, customers_active, retention_rate,
  churn_rate FROM ({COHORT})""",
    "repeat_customers": REPEAT,
    "cohort_cumulative": f"""SELECT cohort_month, months_since_first_purchase, cumulative_orders, cumulative_cohort_revenue,
  cumulative_retention_rate, cumulative_churn_rate, cumulative_avg_revenue_per_customer,
  cumulative_avg_orders_per_customer FROM ({COHORT})""",
    "cohort_channel_mix": f"""SELECT cohort_month, months_since_first_purchase,
  {", ".join(f"{n}_percentage" for _, n in CHANNELS)} FROM ({COHORT})""",
    "subscription_adoption": ADOPTION,
    "gold_cohort": GOLD_COHORT,
    "cohort_ltv_summary": f"""SELECT cohort_month, MAX(cohort_size) AS cohort_size,
  MAX(cumulative_avg_revenue_per_customer) AS max_ltv, MAX(cumulative_orders) AS total_orders FROM ({COHORT}) GROUP BY 1""",
    "latest_cohort_curve": f"""SELECT cohort_month, months_since_first_purchase, cohort_size, customers_active, retention_rate,
  cumulative_avg_revenue_per_customer FROM ({COHORT}) QUALIFY cohort_month = MAX(cohort_month) OVER ()
ORDER BY months_since_first_purchase LIMIT 12""",
    "store_rank": f"SELECT store_id, store_region, daily_revenue, revenue_rank_in_region FROM ({store_base('')})",
    "gold_store_performance": GOLD_STORE,
    "store_snapshot": STORE_SNAPSHOT,
    "store_daily_trend": DAILY,
    "plan_mrr_arr": f"""
SELECT *, {M("mrr * 12", 20)} AS arr FROM (SELECT plan_id, COUNT(*) FILTER (status = 'active') AS active_subscribers,
  {M("SUM(CASE WHEN status = 'active' THEN subscription_amount ELSE 0 END)")} AS mrr,
  {M(f"COALESCE(SUM(CASE WHEN status = 'active' THEN {PER_MONTH} END), 0)")} AS mrr_normalised,
  {MEAN("lifetime_value", "status = 'active'")} AS lifetime_value_avg FROM sub GROUP BY plan_id)""",
    "plan_churn": f"""
SELECT plan_id, COUNT(*) AS subscribers, COUNT(*) FILTER (is_churned) AS churned_subscribers,
  {P("COUNT(*) FILTER (is_churned)", "COUNT(*)")} AS churn_rate, {MEAN("churn_risk_score", "NOT is_churned")} AS avg_open_risk
FROM sub GROUP BY plan_id""",
    "subscription_health_full": HEALTH,
    "gold_subscription_health": GOLD_HEALTH,
}
