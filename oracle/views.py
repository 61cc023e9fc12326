"""The given tables in retail shape, as DuckDB common table expressions (definition order matters)."""

from __future__ import annotations

ORDERS_AS_OF = "DATE '2001-08-02'"
EVENTS_AS_OF = "DATE '2024-01-31'"

VIEWS: dict[str, str] = {}

VIEWS["v_order"] = """
SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, c_nationkey,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
"""

VIEWS["v_amount"] = """
SELECT *, CAST(total_amount * CAST(0.08 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS tax_amount,
  CASE WHEN k % 3 = 0 THEN CAST(total_amount * CAST(0.10 AS DECIMAL(3,2)) AS DECIMAL(12,2))
       ELSE CAST(0 AS DECIMAL(12,2)) END AS discount_amount,
  CAST((k % 5) * CAST(2.5 AS DECIMAL(2,1)) AS DECIMAL(12,2)) AS shipping_cost,
  o_orderdate + (k % 24) * INTERVAL 1 HOUR AS ts
FROM v_order
"""

VIEWS["txn"] = """
SELECT k AS transaction_id, o_custkey AS customer_id, ts AS transaction_timestamp, CAST(ts AS DATE) AS transaction_date,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'online' WHEN '2-HIGH' THEN 'mobile' WHEN '3-MEDIUM' THEN 'in-store'
       ELSE 'marketplace' END AS channel,
  CAST(c_nationkey AS BIGINT) AS store_id,
  CASE k % 3 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'paypal' ELSE 'cash' END AS payment_method,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS payment_status,
  CAST(total_amount - tax_amount - shipping_cost + discount_amount AS DECIMAL(12,2)) AS subtotal,
  tax_amount, shipping_cost, discount_amount, total_amount, 'USD' AS currency,
  CAST(k % 500 AS INTEGER) AS loyalty_points_earned, CAST(k % 7 * 10 AS INTEGER) AS loyalty_points_redeemed,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN CAST([] AS VARCHAR[])
       ELSE ['VIP' || CAST(k % 10 AS VARCHAR), 'FREESHIP'] END AS coupon_codes,
  year(ts) AS transaction_year, month(ts) AS transaction_month, quarter(ts) AS transaction_quarter,
  dayofweek(ts) + 1 AS transaction_day_of_week, hour(ts) AS transaction_hour,
  dayofweek(ts) IN (0, 6) AS is_weekend,
  strftime(ts, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday,
  CASE WHEN month(ts) >= 4 THEN year(ts) ELSE year(ts) - 1 END AS fiscal_year,
  CASE WHEN month(ts) BETWEEN 4 AND 6 THEN 1 WHEN month(ts) BETWEEN 7 AND 9 THEN 2 WHEN month(ts) >= 10 THEN 3
       ELSE 4 END AS fiscal_quarter,
  discount_amount > 0 AS has_discount,
  k % 4 IN (2, 3) AS has_coupon
FROM v_amount
"""

VIEWS["txnf"] = """
SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, transaction_id) = 1 AS is_first_purchase
FROM txn
"""

VIEWS["store"] = """
SELECT CAST(n_nationkey AS BIGINT) AS store_id, n_name AS store_name, r_name AS store_region
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""

VIEWS["v_line"] = """
SELECT l_orderkey * 10 + l_linenumber AS transaction_item_id, l_orderkey AS transaction_id, l_partkey AS product_id,
  l_partkey * 10 + l_linenumber % 3 AS variant_id, CAST(l_quantity AS INTEGER) AS quantity,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS return_quantity,
  CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
  CAST(l_discount * 100 AS DECIMAL(5,2)) AS discount_percentage, CAST(l_tax AS DECIMAL(5,4)) AS tax_rate,
  CASE WHEN l_returnflag = 'R' THEN CASE l_linenumber % 3 WHEN 0 THEN 'defective' WHEN 1 THEN 'changed_mind'
       ELSE 'wrong_item' END END AS return_reason,
  CASE WHEN l_linestatus = 'O' THEN 'processing' ELSE 'shipped' END AS fulfillment_status,
  l_suppkey AS warehouse_id
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""

VIEWS["v_line2"] = """
SELECT *, quantity - return_quantity AS net_quantity,
  CAST(unit_price * CAST(0.70 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_cost,
  CAST(quantity * unit_price AS DECIMAL(12,2)) AS line_subtotal,
  CAST((quantity - return_quantity) * unit_price AS DECIMAL(12,2)) AS kept_subtotal,
  discount_percentage * CAST(0.01 AS DECIMAL(3,2)) AS off
FROM v_line
"""

VIEWS["v_line3"] = """
SELECT *, line_subtotal - line_subtotal * off AS discounted,
  (line_subtotal - line_subtotal * off) * tax_rate AS tax,
  CAST(net_quantity * unit_cost AS DECIMAL(12,2)) AS line_cost
FROM v_line2
"""

VIEWS["item"] = """
SELECT transaction_item_id, transaction_id, product_id, variant_id, quantity, return_quantity, net_quantity, unit_price,
  unit_cost, discount_percentage, tax_rate, line_subtotal,
  CAST(line_subtotal * off AS DECIMAL(12,2)) AS line_discount, CAST(tax AS DECIMAL(12,2)) AS line_tax,
  CAST(discounted + tax AS DECIMAL(12,2)) AS line_total, line_cost,
  CAST(discounted + tax - line_cost AS DECIMAL(12,2)) AS line_profit,
  CAST(CAST(CASE WHEN discounted + tax > 0 THEN ROUND(CAST(discounted + tax - line_cost AS DOUBLE) * 100
    / CAST(discounted + tax AS DOUBLE), 6) ELSE 0 END AS DECIMAL(20,6)) AS DECIMAL(12,2)) AS line_margin_percentage,
  CAST(kept_subtotal - kept_subtotal * off AS DECIMAL(12,2)) AS net_line_revenue,
  return_reason, fulfillment_status, warehouse_id
FROM v_line3
"""

VIEWS["v_part"] = f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category_level1,
  string_split(p_name, ' ')[2] AS category_level2, string_split(p_name, ' ')[1] AS category_level3,
  p_brand AS brand, 'Maker of ' || p_brand AS manufacturer, p_size,
  CAST(p_retailprice * p_size / 50 AS DECIMAL(10,2)) AS list_price, p_partkey AS supplier_id,
  p_size % 14 AS lead_time_days, DATE '1995-01-01' + CAST(p_partkey % 2000 AS INTEGER) AS launch_date,
  CASE WHEN p_size > 45 THEN DATE '1995-01-01' + CAST(p_partkey % 2000 + 400 AS INTEGER) END AS discontinuation_date
FROM part
"""

VIEWS["product"] = f"""
SELECT *, p_size <= 45 AS is_active,
  CAST(list_price * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_cost,
  CAST(CAST(ROUND(CAST(list_price - CAST(list_price * CAST(0.60 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS DOUBLE) * 100
    / CAST(list_price AS DOUBLE), 6) AS DECIMAL(20,6)) AS DECIMAL(12,2)) AS margin_percentage,
  category_level1 || ' > ' || category_level2 || ' > ' || category_level3 AS full_category_path,
  CASE WHEN list_price < 50 THEN 'budget' WHEN list_price < 200 THEN 'mid-range' WHEN list_price < 500 THEN 'premium'
       ELSE 'luxury' END AS price_tier,
  {ORDERS_AS_OF} - launch_date AS product_age_days,
  CASE WHEN p_size > 45 THEN 'discontinued' WHEN {ORDERS_AS_OF} - launch_date < 90 THEN 'introduction'
       WHEN {ORDERS_AS_OF} - launch_date < 365 THEN 'growth' WHEN {ORDERS_AS_OF} - launch_date < 1095 THEN 'maturity'
       ELSE 'decline' END AS lifecycle_stage
FROM v_part
"""

VIEWS["v_sub"] = """
SELECT o_orderkey AS k, o_orderkey AS subscription_id, o_custkey AS customer_id,
  CASE o_orderkey % 3 WHEN 0 THEN 'basic' WHEN 1 THEN 'premium' ELSE 'premium_plus' END AS subscription_type,
  o_custkey % 5 AS plan_id, CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN NOT (o_orderstatus = 'O' AND o_orderkey % 2 = 0)
       THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 720 AS INTEGER) END AS end_date,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 720 AS INTEGER) END AS cancellation_date,
  CAST(o_orderdate AS DATE) + 30 AS next_billing_date,
  CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'cancelled' ELSE 'paused' END AS status,
  CASE o_orderkey % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'quarterly' ELSE 'annual' END AS billing_frequency,
  o_orderkey % 4 <> 3 AS auto_renewal,
  CASE WHEN o_orderstatus = 'F' THEN CASE o_orderkey % 4 WHEN 0 THEN 'too_expensive' WHEN 1 THEN 'not_used'
       WHEN 2 THEN 'payment_failed' ELSE 'moved' END END AS cancellation_reason,
  CAST(CAST(9.99 AS DECIMAL(5,2)) + (o_orderkey % 5) * 10 AS DECIMAL(10,2)) AS subscription_amount
FROM orders
"""

VIEWS["v_sub2"] = f"""
SELECT *, greatest(COALESCE(end_date, {ORDERS_AS_OF}) - start_date, 0) AS subscription_duration_days,
  status = 'cancelled' AS is_churned
FROM v_sub
"""

VIEWS["v_sub3"] = """
SELECT *, CAST(CASE WHEN subscription_duration_days > 0 THEN greatest(1, subscription_duration_days //
  (CASE billing_frequency WHEN 'monthly' THEN 30 WHEN 'quarterly' THEN 90 ELSE 365 END)) ELSE 0 END AS INTEGER)
  AS total_payments_made
FROM v_sub2
"""

VIEWS["sub"] = f"""
SELECT *, CAST(subscription_amount * total_payments_made AS DECIMAL(12,2)) AS lifetime_value,
  CAST(CASE WHEN is_churned THEN 1.0 WHEN NOT auto_renewal AND COALESCE(end_date - {ORDERS_AS_OF}, 999) < 30 THEN 0.7
    WHEN NOT auto_renewal THEN 0.5 WHEN total_payments_made < 3 THEN 0.4 ELSE 0.2 END AS DECIMAL(3,2)) AS churn_risk_score
FROM v_sub3
"""

VIEWS["v_talk"] = """
SELECT event_id AS interaction_id, user_id AS customer_id, date_trunc('second', ts) AS interaction_timestamp,
  CAST(ts AS DATE) AS interaction_date, event_type AS interaction_type,
  CASE event_id % 4 WHEN 0 THEN 'email' WHEN 1 THEN 'web' WHEN 2 THEN 'phone' ELSE 'social' END AS channel,
  event_id % 17 AS agent_id,
  CASE event_id % 3 WHEN 0 THEN 'billing' WHEN 1 THEN 'order_issue' ELSE 'product_inquiry' END AS category,
  CASE event_id % 5 WHEN 0 THEN 'refund' WHEN 1 THEN 'delay' WHEN 2 THEN 'specifications' WHEN 3 THEN 'renewal'
       ELSE 'login' END AS subcategory,
  CASE WHEN event_id % 11 <> 0 THEN CAST((event_id % 201 - 100) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) END
    AS sentiment_score,
  CAST(event_id % 240 AS INTEGER) AS resolution_time_minutes,
  CASE WHEN event_id % 6 <> 0 THEN CAST(event_id % 6 AS INTEGER) END AS satisfaction_rating,
  CASE event_id % 7 WHEN 0 THEN 'Will escalate by letter' WHEN 1 THEN 'Handled at once' WHEN 2 THEN 'URGENT: call back'
       WHEN 3 THEN 'Asked for a Supervisor' WHEN 4 THEN 'Follow-up sent' ELSE 'Resolved' END AS notes
FROM events
"""

VIEWS["talk"] = """
SELECT *, COALESCE(satisfaction_rating > 0 AND resolution_time_minutes > 0, FALSE) AS is_resolved,
  lower(notes) LIKE '%escalat%' OR lower(notes) LIKE '%manager%' OR lower(notes) LIKE '%supervisor%'
    OR lower(notes) LIKE '%urgent%' AS is_escalated,
  year(interaction_date) AS interaction_year, month(interaction_date) AS interaction_month
FROM v_talk
"""

VIEWS["v_stock"] = """
SELECT l_orderkey * 10 + l_linenumber AS snapshot_id, CAST(l_shipdate AS DATE) AS snapshot_date, l_partkey AS product_id,
  l_partkey * 10 + l_linenumber % 3 AS variant_id, l_suppkey AS warehouse_id, p_size AS quantity_on_hand,
  CAST(l_quantity AS INTEGER) AS quantity_reserved, p_size - CAST(l_quantity AS INTEGER) AS quantity_available,
  p_size % 20 AS reorder_point, p_size * 2 AS reorder_quantity
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
"""

VIEWS["stock"] = """
SELECT *, CASE WHEN reorder_point > 0 THEN CAST(trunc(quantity_available * 30.0 / reorder_point) AS INTEGER) ELSE 999 END
    AS days_of_supply,
  CASE WHEN quantity_available <= 0 THEN 'out_of_stock' WHEN quantity_available < reorder_point THEN 'low_stock'
       WHEN quantity_available > reorder_point * 3 THEN 'overstock' ELSE 'in_stock' END AS stock_status,
  quantity_available <= 0 AS is_stockout, CASE WHEN quantity_available <= 0 THEN 1 ELSE 0 END AS stockout_duration_days
FROM v_stock
"""

VIEWS["campaign"] = """
SELECT s_suppkey AS campaign_id, 'Campaign ' || s_name AS campaign_name,
  CASE s_suppkey % 5 WHEN 0 THEN 'email' WHEN 1 THEN 'social' WHEN 2 THEN 'display' WHEN 3 THEN 'search'
       ELSE 'affiliate' END AS campaign_type,
  CASE s_suppkey % 4 WHEN 0 THEN 'email' WHEN 1 THEN 'facebook' WHEN 2 THEN 'google_ads' ELSE 'instagram' END AS channel,
  DATE '2024-01-01' + CAST(s_suppkey % 20 AS INTEGER) AS start_date,
  DATE '2024-01-01' + CAST(s_suppkey % 20 + 30 AS INTEGER) AS end_date, 31 AS duration_days,
  CAST(abs(s_acctbal) + 100 AS DECIMAL(12,2)) AS budget,
  'kind-' || CAST(s_suppkey % 3 AS VARCHAR) AS interest, 'segment-' || CAST(s_suppkey % 6 AS VARCHAR) AS audience_segment
FROM supplier
"""

VIEWS["cevent"] = """
SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS campaign_id, user_id AS customer_id,
  CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'conversion' WHEN 'error' THEN 'unsubscribe'
       ELSE event_type END AS event_type,
  CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
  CAST(ts AS DATE) AS event_date,
  CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS attributed_revenue
FROM events
"""

VIEWS["touch"] = """
SELECT user_id AS customer_id, event_id AS touch_id, ts, CAST(ts AS DATE) AS d,
  CASE WHEN event_type = 'purchase' THEN CASE event_id % 4 WHEN 0 THEN 'online' WHEN 1 THEN 'mobile' WHEN 2 THEN 'in-store'
       ELSE 'marketplace' END ELSE event_type END AS channel,
  CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS campaign_id,
  CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_purchase,
  CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) ELSE CAST(0 AS DECIMAL(12,2)) END AS revenue
FROM events
"""

VIEWS["journey"] = """
SELECT p.touch_id AS transaction_id, p.customer_id, p.ts AS bought_at, p.d AS bought_day, p.revenue AS transaction_revenue,
  t.touch_id, t.ts, t.d, t.channel, t.campaign_id, t.is_purchase, p.d - t.d AS age,
  row_number() OVER (PARTITION BY p.touch_id ORDER BY t.ts, t.is_purchase, t.touch_id) AS seq,
  row_number() OVER (PARTITION BY p.touch_id ORDER BY t.ts DESC, t.is_purchase DESC, t.touch_id DESC) AS rev,
  COUNT(*) OVER (PARTITION BY p.touch_id) AS total
FROM touch p JOIN touch t ON p.customer_id = t.customer_id AND t.ts <= p.ts AND p.d - t.d <= 30
WHERE p.is_purchase = 1
"""

VIEWS["bought"] = """
SELECT customer_id, transaction_id AS touch_id, transaction_timestamp AS ts, channel, CAST(NULL AS BIGINT) AS campaign_id, 1 AS is_purchase,
  total_amount AS revenue, CAST(total_amount - tax_amount - shipping_cost AS DECIMAL(12,2)) AS profit FROM txn
UNION ALL
SELECT customer_id, interaction_id, interaction_timestamp - (8200 + interaction_id % 2300) * INTERVAL 1 DAY, interaction_type, NULL, 0, 0, 0 FROM talk
"""

VIEWS["sale"] = """
SELECT p.touch_id AS transaction_id, p.customer_id, p.ts AS bought_at, CAST(p.ts AS DATE) AS bought_day, p.revenue AS transaction_revenue,
  p.profit AS transaction_profit, t.touch_id, t.ts, CAST(t.ts AS DATE) AS d, t.channel, t.campaign_id, t.is_purchase,
  CAST(p.ts AS DATE) - CAST(t.ts AS DATE) AS age,
  row_number() OVER (PARTITION BY p.touch_id ORDER BY t.ts, t.is_purchase, t.touch_id) AS seq,
  row_number() OVER (PARTITION BY p.touch_id ORDER BY t.ts DESC, t.is_purchase DESC, t.touch_id DESC) AS rev,
  COUNT(*) OVER (PARTITION BY p.touch_id) AS total
FROM bought p JOIN bought t ON p.customer_id = t.customer_id AND t.ts <= p.ts AND CAST(p.ts AS DATE) - CAST(t.ts AS DATE) <= 30
WHERE p.is_purchase = 1
"""

VIEWS["querylog"] = """
SELECT 'job_' || CAST(event_id % 12 AS VARCHAR) AS job, event_id AS statement_id, lower(regexp_replace(regexp_replace(
  CASE event_id % 4
  WHEN 0 THEN 'INSERT OVERWRITE TABLE silver.table_' || event_id % 5 || ' SELECT * FROM bronze.feed_' || event_id % 7
    || ' -- FROM bronze.ignored' || chr(10) || ' WHERE id > 0'
  WHEN 1 THEN 'INSERT INTO gold.mart_' || event_id % 3 || ' WITH base AS (SELECT * FROM silver.table_' || event_id % 5
    || '), totals AS (SELECT count(*) n FROM base JOIN silver.calendar ON 1 = 1) SELECT * FROM totals /* JOIN bronze.ignored */'
  WHEN 2 THEN 'CREATE TABLE gold.mart_' || event_id % 3 || ' USING PARQUET LOCATION ''s3a://data/mart/' || event_id % 3
    || ''' AS SELECT * FROM silver.table_' || event_id % 5 || ' JOIN bronze.feed_' || event_id % 7 || ' USING (id)'
  ELSE 'SELECT count(*) FROM silver.table_' || event_id % 5 END,
  '/\\*.*?\\*/', ' ', 'gs'), '--[^\\n]*', ' ', 'g')) AS q
FROM events
"""
