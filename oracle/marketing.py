"""Oracle statements for campaigns and attribution."""

from __future__ import annotations

import re

from oracle.customers import d2
from oracle.sql import D, M, MEAN, P, R
from oracle.views import EVENTS_AS_OF as AS_OF

KEYS = "campaign_id, coupon_code, channel"
ZERO = "CAST(0 AS DECIMAL(12,2))"

COUPONS = """SELECT * EXCLUDE (coupon_codes), TRY_CAST(NULLIF(regexp_extract(coupon_code, '[0-9]+'), '') AS BIGINT) AS campaign_id
FROM (SELECT *, unnest(list_distinct(coupon_codes)) AS coupon_code FROM txnf WHERE len(coupon_codes) > 0)"""

ORGANIC = """SELECT * EXCLUDE (coupon_codes), 'ORGANIC' AS coupon_code, CAST(0 AS BIGINT) AS campaign_id FROM txnf
WHERE coupon_codes IS NULL OR len(coupon_codes) = 0"""

ATTRIBUTED = f"""
SELECT *, {R("attributed_revenue", "attributed_transactions")} AS avg_transaction_value,
  end_date - start_date + 1 AS campaign_duration_days
FROM (SELECT {KEYS}, COUNT(*) AS attributed_transactions, COUNT(DISTINCT customer_id) AS unique_customers_reached,
  {M("SUM(total_amount)")} AS attributed_revenue, {M("SUM(total_amount - tax_amount - shipping_cost)")} AS attributed_profit,
  {M(f"SUM(CASE WHEN is_first_purchase THEN total_amount ELSE {ZERO} END)")} AS new_customer_revenue,
  {M(f"SUM(CASE WHEN NOT is_first_purchase THEN total_amount ELSE {ZERO} END)")} AS existing_customer_revenue,
  COUNT(*) FILTER (is_first_purchase) AS new_customer_acquisitions, MIN(transaction_date) AS start_date,
  MAX(transaction_date) AS end_date
FROM (SELECT * FROM ({COUPONS}) UNION ALL BY NAME SELECT * FROM ({ORGANIC})) GROUP BY {KEYS})"""

FUNNEL = f"""
SELECT *, {P("clicks", "impressions")} AS click_through_rate, {P("conversions", "clicks")} AS conversion_rate
FROM (SELECT campaign_id, COUNT(DISTINCT customer_id) AS customers_reached,
  {", ".join(f"COUNT(*) FILTER (event_type = '{k}') AS {k}s" for k in ("impression", "click", "conversion", "unsubscribe"))},
  {M("SUM(attributed_revenue)")} AS event_revenue FROM cevent GROUP BY campaign_id)"""

SPEND = f"""SELECT campaign_id, budget AS campaign_budget,
  {D(f"ROUND(CAST(budget AS DOUBLE) * greatest(least({AS_OF} - start_date + 1, duration_days), 0) / duration_days, 6)", 18, 2)}
  AS campaign_spend FROM campaign"""


def cents(name: str) -> str:
    return f"CASE WHEN coupon_code = 'ORGANIC' THEN CAST(0 AS DECIMAL(18,2)) ELSE {D(f'ROUND(CAST({name} AS DOUBLE) * share, 6)', 18, 2)} END"


def units(name: str) -> str:
    return f"CAST(ROUND(ROUND(CAST({name} AS DOUBLE) * share, 6)) AS BIGINT)"


LIFETIME = "(avg_transaction_value * 5)"

PRICED = f"""
SELECT *, {P("total_clicks", "total_impressions")} AS click_through_rate,
  {P("attributed_transactions", "total_clicks")} AS conversion_rate,
  {P("actual_spend", "total_budget")} AS budget_utilization_rate, {R("actual_spend", "total_impressions")} AS cost_per_impression,
  {R("actual_spend", "total_clicks")} AS cost_per_click,
  {R("actual_spend", "new_customer_acquisitions")} AS cost_per_acquisition,
  {P("(attributed_profit - actual_spend)", "actual_spend")} AS roi_percentage, {R("attributed_revenue", "actual_spend")} AS roas,
  {R("attributed_revenue", "total_impressions")} AS revenue_per_impression,
  {R("attributed_profit", "actual_spend")} AS profit_per_dollar_spent, ROUND({LIFETIME}, 6) AS avg_clv_of_acquired_customers,
  {P(f"({LIFETIME} * new_customer_acquisitions)", "actual_spend")} AS estimated_lifetime_roi
FROM (SELECT a.*, {cents("campaign_budget")} AS total_budget, {cents("campaign_spend")} AS actual_spend,
  {units("impressions")} AS total_impressions, {units("clicks")} AS total_clicks, attributed_transactions AS total_conversions,
  CASE WHEN coupon_code = 'ORGANIC' THEN 'Organic Traffic'
    ELSE 'Campaign_' || COALESCE(CAST(a.campaign_id AS VARCHAR), '') || '_' || coupon_code END AS campaign_name,
  CASE WHEN coupon_code = 'ORGANIC' THEN 'organic' WHEN channel = 'online' THEN 'digital' WHEN channel = 'mobile' THEN 'mobile_app'
    ELSE 'offline' END AS campaign_type
FROM (SELECT *, CASE WHEN coupon_code <> 'ORGANIC' THEN CAST(attributed_transactions AS DOUBLE)
    / SUM(CASE WHEN coupon_code <> 'ORGANIC' THEN attributed_transactions END) OVER (PARTITION BY campaign_id) END AS share
  FROM ({ATTRIBUTED})) a
LEFT JOIN ({SPEND}) s ON a.campaign_id = s.campaign_id LEFT JOIN ({FUNNEL}) f ON a.campaign_id = f.campaign_id)"""

BASELINE = f"(SELECT {MEAN('r')} FROM (SELECT channel, SUM(total_amount) AS r FROM ({ORGANIC}) GROUP BY 1))"


def increment(name: str, factor: str) -> str:
    return D(f"ROUND(CAST({name} AS DOUBLE) - COALESCE({BASELINE}, 0.0) * {factor}::DOUBLE, 6)", 18, 2)


VERSUS = f"""
SELECT *, ROUND(roi_percentage - {MEAN("CAST(roi_percentage AS DECIMAL(30,6))").replace("SUM(CAST(roi_percentage AS DECIMAL(30,6)))",
  "SUM(CAST(roi_percentage AS DECIMAL(30,6))) OVER (PARTITION BY channel)").replace("COUNT(CAST(roi_percentage AS DECIMAL(30,6)))",
  "COUNT(roi_percentage) OVER (PARTITION BY channel)")}, 6) AS roi_vs_channel_avg,
  dense_rank() OVER (PARTITION BY channel ORDER BY attributed_revenue DESC) AS performance_rank_in_channel FROM ({PRICED})"""

GOLD_CAMPAIGN = f"""
SELECT {AS_OF} AS analysis_date, campaign_id, coupon_code, campaign_name, campaign_type, channel, start_date, end_date,
  campaign_duration_days, total_budget, actual_spend, {d2(12, "budget_utilization_rate", "click_through_rate", "conversion_rate")},
  total_impressions, total_clicks, total_conversions, unique_customers_reached, attributed_revenue, attributed_transactions,
  new_customer_revenue, existing_customer_revenue, attributed_profit,
  {D("cost_per_impression", 10, 4)} AS cost_per_impression, {D("revenue_per_impression", 10, 4)} AS revenue_per_impression,
  {d2(10, "cost_per_click", "cost_per_acquisition", "avg_clv_of_acquired_customers", "profit_per_dollar_spent")},
  {d2(12, "roi_percentage", "roas", "estimated_lifetime_roi", "roi_vs_channel_avg")},
  {increment("attributed_revenue", "1.0")} AS incremental_revenue,
  {increment("attributed_profit", "0.3")} AS incremental_profit, performance_rank_in_channel FROM ({VERSUS})"""

# --- attribution, straight from the listed journeys ---

SUMMARY = """SELECT transaction_id, customer_id, transaction_revenue, bought_day, total,
  MAX(CASE WHEN seq = 1 THEN channel END) AS fc, MAX(CASE WHEN rev = 1 THEN channel END) AS lc,
  MAX(CASE WHEN seq = 1 THEN campaign_id END) AS fi, MAX(CASE WHEN rev = 1 THEN campaign_id END) AS li,
  MAX(d) - MIN(d) AS days FROM journey GROUP BY ALL"""

COUNTS = """SELECT transaction_id, channel, COUNT(*) AS n, ROUND(SUM(pow(2.0, -age / 7.0::DOUBLE)), 9) AS w
FROM journey GROUP BY 1, 2"""

SHARES = {
    "linear": "CAST(n AS DOUBLE) / total",
    "time_decay": "w / SUM(w) OVER (PARTITION BY transaction_id)",
    "first_last": "CASE WHEN total = 1 THEN 1.0::DOUBLE ELSE f * 0.45::DOUBLE + l * 0.55::DOUBLE END",
    "position": """CASE WHEN total = 1 THEN 1.0::DOUBLE WHEN total = 2 THEN f * 0.5::DOUBLE + l * 0.5::DOUBLE
      ELSE f * 0.4::DOUBLE + l * 0.4::DOUBLE + CAST(n - f - l AS DOUBLE) / greatest(total - 2, 1) * 0.2::DOUBLE END""",
}


def credit(model: str) -> str:
    return f"""SELECT transaction_id, channel, transaction_revenue, CAST(c + CASE WHEN channel = lc THEN transaction_revenue
    - SUM(c) OVER (PARTITION BY transaction_id) ELSE 0 END AS DECIMAL(12,2)) AS credit
  FROM (SELECT *, {D(f"ROUND(CAST(transaction_revenue AS DOUBLE) * ({SHARES[model]}), 6)", 12, 2)} AS c
    FROM (SELECT *, CAST(channel = fc AS INTEGER) AS f, CAST(channel = lc AS INTEGER) AS l
      FROM ({COUNTS}) JOIN ({SUMMARY}) USING (transaction_id)))"""


def credits(model: str) -> str:
    return f"SELECT transaction_id, channel, credit FROM ({credit(model)}) WHERE credit <> 0 OR transaction_revenue = 0"


def as_map(model: str, name: str) -> str:
    return f"""(SELECT transaction_id, string_agg(channel || '=' || CAST(credit AS VARCHAR), ';' ORDER BY channel) AS {name}
  FROM ({credit(model)}) WHERE credit <> 0 GROUP BY 1)"""


GOLD_ATTRIBUTION = f"""
WITH s AS ({SUMMARY})
SELECT bought_day AS attribution_date, customer_id, s.transaction_id, transaction_revenue,
  profit AS transaction_profit, fc AS first_touch_channel, fi AS first_touch_campaign_id,
  transaction_revenue AS first_touch_attribution_revenue, lc AS last_touch_channel, li AS last_touch_campaign_id,
  transaction_revenue AS last_touch_attribution_revenue, total AS touchpoint_count,
  {D(R("transaction_revenue", "total"), 12, 2)} AS linear_attribution_per_touchpoint, time_decay_attribution_map,
  position_based_attribution_map, data_driven_attribution_map, days AS journey_length_days, journey_touchpoints
FROM s LEFT JOIN {as_map("time_decay", "time_decay_attribution_map")} USING (transaction_id)
LEFT JOIN {as_map("position", "position_based_attribution_map")} USING (transaction_id)
LEFT JOIN {as_map("first_last", "data_driven_attribution_map")} USING (transaction_id)
JOIN (SELECT transaction_id, string_agg(channel, ';' ORDER BY seq) AS journey_touchpoints FROM journey GROUP BY 1)
  USING (transaction_id)"""

# The same models over purchases and interactions instead of events.
GOLD_ATTRIBUTION = re.sub(r"\bjourney\b", "sale", GOLD_ATTRIBUTION).replace(
    "FROM s LEFT JOIN", "FROM s JOIN (SELECT DISTINCT transaction_id, transaction_profit AS profit FROM sale) USING (transaction_id) LEFT JOIN", 1)

STATEMENTS = {
    "coupon_explode": f"SELECT transaction_id, coupon_code, campaign_id, channel, total_amount FROM ({COUPONS})",
    "campaign_vs_organic": ATTRIBUTED,
    "campaign_funnel": FUNNEL,
    "campaign_unit_economics": f"""SELECT {KEYS}, campaign_name, campaign_type, total_budget, actual_spend, total_impressions,
  total_clicks, total_conversions, click_through_rate, conversion_rate, budget_utilization_rate, cost_per_impression,
  cost_per_click, cost_per_acquisition, roi_percentage, roas, revenue_per_impression, profit_per_dollar_spent,
  avg_clv_of_acquired_customers, estimated_lifetime_roi FROM ({PRICED})""",
    "campaign_incremental": f"""SELECT {KEYS}, {increment("attributed_revenue", "1.0")} AS incremental_revenue,
  {increment("attributed_profit", "0.3")} AS incremental_profit FROM ({ATTRIBUTED})""",
    "roi_vs_channel": f"SELECT {KEYS}, roi_percentage, roi_vs_channel_avg FROM ({VERSUS})",
    "campaign_rank": f"SELECT {KEYS}, attributed_revenue, performance_rank_in_channel FROM ({VERSUS})",
    "gold_campaign_roi": GOLD_CAMPAIGN,
    "topk_nulls_last": f"""SELECT campaign_name, coupon_code, channel, attributed_revenue, actual_spend, roi_percentage, roas
FROM ({PRICED}) WHERE coupon_code <> 'ORGANIC' ORDER BY roi_percentage DESC NULLS LAST, coupon_code, channel LIMIT 10""",
    "campaign_summary": f"""SELECT COUNT(*) AS total_campaigns, {M("SUM(attributed_revenue)")} AS total_revenue,
  {M("SUM(actual_spend)")} AS total_spend, {MEAN("CAST(roi_percentage AS DECIMAL(30,6))")} AS avg_roi,
  {MEAN("CAST(roas AS DECIMAL(30,6))")} AS avg_roas FROM ({PRICED}) WHERE coupon_code <> 'ORGANIC'""",
    "touchpoint_union": f"""
SELECT customer_id, transaction_id AS touch_id, strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS touch_timestamp, channel,
  CAST(NULL AS BIGINT) AS campaign_id, 'purchase' AS event_type, total_amount AS revenue,
  CAST(total_amount - tax_amount - shipping_cost AS DECIMAL(12,2)) AS profit FROM txn
UNION ALL SELECT customer_id, interaction_id, strftime(interaction_timestamp, '%Y-%m-%d %H:%M:%S'), interaction_type, NULL,
  'interaction', {ZERO}, {ZERO} FROM talk""",
    "touchpoint_seq": """SELECT customer_id, touch_id,
  row_number() OVER (PARTITION BY customer_id ORDER BY ts, is_purchase, touch_id) AS touchpoint_seq FROM touch""",
    "journey_lookback": "SELECT transaction_id, touch_id, channel, age AS days_before FROM journey",
    "journey_collect": """SELECT transaction_id, COUNT(*) AS touches, string_agg(channel || '@' ||
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '@' || campaign_id || '@' ||
  CASE WHEN is_purchase = 1 THEN 'purchase' ELSE 'interaction' END, ';' ORDER BY seq) AS journey FROM journey GROUP BY 1""",
    "attr_first_touch": f"""SELECT transaction_id, customer_id, fc AS first_touch_channel, fi AS first_touch_campaign_id,
  transaction_revenue AS first_touch_attribution_revenue FROM ({SUMMARY})""",
    "attr_last_touch": f"""SELECT transaction_id, customer_id, lc AS last_touch_channel, li AS last_touch_campaign_id,
  transaction_revenue AS last_touch_attribution_revenue FROM ({SUMMARY})""",
    "attr_linear": credits("linear"),
    "attr_time_decay": credits("time_decay"),
    "attr_position": credits("position"),
    "attr_weighted_45_55": credits("first_last"),
    "attr_channel_summary": f"""
SELECT fc AS channel, COUNT(*) AS conversions, {M("SUM(transaction_revenue)")} AS attributed_revenue, 'first' AS touch
FROM ({SUMMARY}) GROUP BY 1
UNION ALL SELECT lc, COUNT(*), {M("SUM(transaction_revenue)")}, 'last' FROM ({SUMMARY}) GROUP BY 1""",
    "journey_stats": f"""SELECT COUNT(*) AS conversions, {MEAN("days")} AS avg_journey_length, {MEAN("total")} AS avg_touchpoints,
  MAX(total) AS max_touchpoints FROM ({SUMMARY})""",
    "gold_attribution": GOLD_ATTRIBUTION,
}
