"""Oracle statements for sources, silver tables and single rules."""

from __future__ import annotations

STATEMENTS = {
    "bronze_csv_roundtrip": """
SELECT 'TXN' || lpad(CAST(transaction_id AS VARCHAR), 12, '0') AS transaction_id,
  'CUST' || lpad(CAST(customer_id AS VARCHAR), 12, '0') AS customer_id,
  strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp,
  CASE WHEN channel = 'in-store' THEN 'store' ELSE channel END AS channel,
  CASE WHEN channel = 'in-store' THEN 'STR' || lpad(CAST(store_id AS VARCHAR), 3, '0') END AS store_id, payment_method, payment_status,
  CAST(subtotal AS VARCHAR) AS subtotal, CAST(tax_amount AS VARCHAR) AS tax_amount, CAST(shipping_cost AS VARCHAR) AS shipping_cost,
  CAST(discount_amount AS VARCHAR) AS discount_amount, CAST(total_amount AS VARCHAR) AS total_amount, currency,
  CAST(loyalty_points_earned AS VARCHAR) AS loyalty_points_earned, CAST(loyalty_points_redeemed AS VARCHAR) AS loyalty_points_redeemed,
  CASE transaction_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '[]'
    ELSE '["VIP' || CAST(transaction_id % 10 AS VARCHAR) || '","FREESHIP"]' END AS coupon_codes,
  'orders_feed' AS _source_system, strftime(date_trunc('month', transaction_timestamp), '%Y-%m-%d 00:00:00') AS _ingestion_timestamp,
  'orders_' || strftime(transaction_timestamp, '%Y%m') || '.json' AS _file_name, transaction_id AS _record_offset
FROM txn""",
    "load_report": """
WITH feeds AS (
  SELECT 'transactions_raw' AS table_name, COUNT(*) AS n, 0 AS bad FROM orders
  UNION ALL SELECT 'transaction_items_raw', COUNT(*), 0 FROM lineitem
  UNION ALL SELECT 'subscriptions_raw', COUNT(*), 0 FROM orders
  UNION ALL SELECT 'customer_interactions_raw', COUNT(*), 0 FROM events
  UNION ALL SELECT 'product_catalog_raw', COUNT(*), 0 FROM part
  UNION ALL SELECT 'inventory_snapshots_raw', COUNT(*), 0 FROM lineitem
  UNION ALL SELECT 'marketing_campaigns_raw', COUNT(*), 0 FROM supplier
  UNION ALL SELECT 'campaign_events_raw', COUNT(*) FILTER (event_id % 100 <> 0), COUNT(*) FILTER (event_id % 100 = 0) FROM events)
SELECT 1 AS load, table_name, 'OK' AS status, n AS row_count, bad AS rejected_count, n AS published_rows FROM feeds
UNION ALL SELECT 2, table_name, CASE WHEN table_name = 'inventory_snapshots_raw' THEN 'OK' ELSE 'FAILED' END,
  CASE WHEN table_name = 'inventory_snapshots_raw' THEN n ELSE 0 END, 0, n
FROM feeds WHERE table_name IN ('product_catalog_raw', 'marketing_campaigns_raw', 'inventory_snapshots_raw')""",
    "load_quarantine": """
SELECT 'campaign_events_raw' AS table_name, 'EVT' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS row_key,
  '_ingestion_timestamp' AS column_name, 'late ' || event_id AS text FROM events WHERE event_id % 100 = 0""",
    "bronze_since": """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS row_count
FROM orders WHERE date_trunc('month', o_orderdate) > TIMESTAMP '2001-01-01' GROUP BY ALL""",
    "dedupe_latest": """
SELECT 'TXN' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS transaction_id, 'PROD' || CAST(l_partkey AS VARCHAR) AS product_id,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity, 'WH' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS warehouse_id,
  strftime(date_trunc('month', l_shipdate), '%Y-%m-%d 00:00:00') AS _ingestion_timestamp, CAST(l_linenumber AS BIGINT) AS _record_offset
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY date_trunc('month', l_shipdate) DESC, l_linenumber DESC,
  CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) DESC, l_suppkey DESC) = 1""",
    "clean_template": """
SELECT 'TXN' || lpad(CAST(transaction_id AS VARCHAR), 12, '0') AS transaction_id, payment_method,
  CAST(loyalty_points_redeemed AS VARCHAR) AS loyalty_points_redeemed
FROM txn WHERE loyalty_points_redeemed > 0""",
    "validate_nonempty": """
SELECT 'transactions_raw' AS table_name, COUNT(*) AS row_count, 'OK' AS status FROM orders
UNION ALL SELECT 'transaction_items_raw', COUNT(*), 'OK' FROM lineitem
UNION ALL SELECT 'subscriptions_raw', COUNT(*), 'OK' FROM orders
UNION ALL SELECT 'product_catalog_raw', COUNT(*), 'OK' FROM part
UNION ALL SELECT 'inventory_snapshots_raw', COUNT(*), 'OK' FROM lineitem
UNION ALL SELECT 'customer_interactions_raw', COUNT(*), 'OK' FROM events
UNION ALL SELECT 'no_rows', 0, 'EMPTY' UNION ALL SELECT 'not_there', NULL, 'ERROR'""",
    "table_row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in ("orders", "lineitem", "customer", "part", "events", "supplier", "nation", "region")
    ),
    "cohort_without_subs": """
WITH f AS (SELECT customer_id, MIN(date_trunc('month', transaction_date)) AS c FROM txn GROUP BY 1),
a AS (SELECT CAST(f.c AS DATE) AS cohort_month, date_diff('month', f.c, date_trunc('month', transaction_date)) AS o,
  COUNT(DISTINCT txn.customer_id) AS n FROM txn JOIN f USING (customer_id) GROUP BY 1, 2)
SELECT cohort_month, o AS months_since_first_purchase,
  MAX(CASE WHEN o = 0 THEN n END) OVER (PARTITION BY cohort_month) AS cohort_size, n AS customers_active,
  0.0::DOUBLE AS subscription_adoption_rate, 0.0::DOUBLE AS avg_subscription_value FROM a""",
    "silver_transactions": """
WITH ret AS (SELECT l_orderkey AS transaction_id, bool_or(l_returnflag = 'R' AND l_quantity > 0) AS r FROM lineitem GROUP BY 1)
SELECT txnf.* EXCLUDE (store_id, coupon_codes, transaction_timestamp),
  CASE WHEN channel = 'in-store' THEN store_id END AS store_id,
  array_to_string(coupon_codes, ',') AS coupon_codes,
  strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp,
  COALESCE(r, FALSE) AS is_return_transaction, 'orders_feed' AS source_system,
  '2001-08-02 06:00:00' AS created_timestamp, '2001-08-02 06:00:00' AS updated_timestamp
FROM txnf LEFT JOIN ret USING (transaction_id)""",
    "silver_items_economics": "SELECT *, 'warehouse' AS location_type FROM item",
    "silver_subscriptions": """
SELECT * EXCLUDE (k), '2001-08-02 06:00:00' AS effective_start_date, CAST(NULL AS VARCHAR) AS effective_end_date,
  TRUE AS is_current FROM sub""",
    "silver_product_catalog": """
SELECT product.* EXCLUDE (p_size), CAST(p_size / 10.0 AS DECIMAL(8,3)) AS weight_kg,
  category_level3 || ',' || category_level2 AS tags, '2001-08-02 06:00:00' AS effective_start_date,
  CAST(NULL AS VARCHAR) AS effective_end_date, TRUE AS is_current FROM product""",
    "silver_inventory": "SELECT * FROM stock",
    "silver_interactions": """
SELECT * EXCLUDE (notes, interaction_timestamp),
  strftime(interaction_timestamp, '%Y-%m-%d %H:%M:%S') AS interaction_timestamp FROM talk""",
    "silver_campaigns": """
SELECT campaign_id, campaign_name, campaign_type, channel, start_date, end_date, duration_days, budget,
  '18-99' AS audience_age_range, 'sample,' || interest AS audience_interests, audience_segment, campaign_id AS creative_id
FROM campaign""",
    "silver_campaign_events": "SELECT * FROM cevent",
    "scd2_history": """
WITH v AS (SELECT l_partkey AS product_id, CAST(l_shipdate AS DATE) AS arrived,
  MAX({'a': CAST(floor(l_quantity / 25) AS INTEGER), 'b': l_returnflag}) AS m FROM lineitem GROUP BY 1, 2),
c AS (SELECT *, lag(m) OVER (PARTITION BY product_id ORDER BY arrived) AS p FROM v),
h AS (SELECT * FROM c WHERE p IS NULL OR p <> m)
SELECT product_id, m.a AS pack_class, m.b AS terms, arrived AS effective_start_date,
  lead(arrived) OVER (PARTITION BY product_id ORDER BY arrived) AS effective_end_date,
  lead(arrived) OVER (PARTITION BY product_id ORDER BY arrived) IS NULL AS is_current FROM h""",
    "scd2_current": """
SELECT l_partkey AS product_id, m.a AS pack_class, m.b AS terms, arrived AS effective_start_date FROM (
WITH v AS (SELECT l_partkey, CAST(l_shipdate AS DATE) AS arrived,
  MAX({'a': CAST(floor(l_quantity / 25) AS INTEGER), 'b': l_returnflag}) AS m FROM lineitem GROUP BY 1, 2),
c AS (SELECT *, lag(m) OVER (PARTITION BY l_partkey ORDER BY arrived) AS p FROM v)
SELECT * FROM c WHERE p IS NULL OR p <> m QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY arrived DESC) = 1)""",
    "schema_alignment": """
SELECT transaction_id, customer_id, transaction_date, total_amount, CAST(NULL AS VARCHAR) AS payment_method, CAST(NULL AS INTEGER) AS coupons
FROM txn""",
    "metadata_stamp": """
SELECT 'events_feed' AS source_system, '2001-08-02 06:00:00' AS created_timestamp, COUNT(*) AS row_count FROM events""",
    "code_to_id": """
SELECT transaction_id, customer_id, CASE WHEN channel = 'in-store' THEN store_id END AS store_id,
  CAST(NULL AS BIGINT) AS digitless, CASE WHEN channel = 'in-store' THEN 'store' END AS location_type FROM txn""",
    "calendar_parts": """
SELECT transaction_id, transaction_year, transaction_month, transaction_quarter, transaction_day_of_week, transaction_hour,
  is_weekend FROM txn""",
    "fiscal_calendar": "SELECT transaction_id, transaction_date, fiscal_year, fiscal_quarter FROM txn",
    "first_purchase_flag": "SELECT transaction_id, customer_id, is_first_purchase FROM txnf",
    "holiday_flag": "SELECT transaction_date, is_holiday, COUNT(*) AS orders FROM txn GROUP BY ALL",
    "discount_coupon_flags": "SELECT transaction_id, has_discount, has_coupon FROM txn",
    "subscription_payments":
        "SELECT subscription_id, billing_frequency, subscription_duration_days, total_payments_made FROM sub",
    "churn_risk_score": "SELECT subscription_id, status, is_churned, churn_risk_score FROM sub",
    "price_tier": "SELECT product_id, list_price, price_tier FROM product",
    "lifecycle_stage": "SELECT product_id, is_active, product_age_days, lifecycle_stage FROM product",
    "category_path": """
SELECT product_id, full_category_path, CASE WHEN product_id % 3 = 0 THEN category_level1 || ' > ' || category_level3
  ELSE full_category_path END AS path_with_gap FROM product""",
    "escalation_flag": "SELECT interaction_id, notes AS notes_text, is_escalated FROM talk",
}
