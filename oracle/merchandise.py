"""Oracle statements for products, categories and baskets."""

from __future__ import annotations

from oracle.customers import d2, nulls
from oracle.sql import D, G, M, MEAN, N, P, R
from oracle.views import ORDERS_AS_OF as AS_OF

LINES = "SELECT item.*, customer_id, is_first_purchase, transaction_date, total_amount FROM item JOIN txnf USING (transaction_id)"

PRODUCT = f"""
SELECT b.*, total_customers - new_customers AS repeat_customers, product_name, category_level1, category_level2, brand
FROM (SELECT product_id, {N("SUM(net_quantity)")} AS total_units_sold, COUNT(*) AS total_transactions,
  COUNT(DISTINCT transaction_id) AS total_orders, COUNT(DISTINCT customer_id) AS total_customers,
  COUNT(DISTINCT CASE WHEN is_first_purchase THEN customer_id END) AS new_customers,
  {M("SUM(line_total)")} AS gross_revenue, {M("SUM(net_line_revenue)")} AS net_revenue,
  {M("SUM(line_discount)")} AS total_discounts, {M("SUM(line_cost)")} AS total_cost,
  {M("SUM(net_line_revenue - line_cost)")} AS gross_profit, {M("SUM(net_line_revenue - line_cost)")} AS contribution_margin,
  {P("SUM(net_line_revenue - line_cost)", "SUM(net_line_revenue)")} AS gross_margin_percentage,
  {N("SUM(return_quantity)")} AS units_returned,
  {P("SUM(return_quantity)", "SUM(net_quantity) + SUM(return_quantity)")} AS return_rate,
  {M("SUM(return_quantity * unit_price)")} AS return_value, {MEAN("unit_price")} AS avg_selling_price,
  {MEAN("discount_percentage")} AS avg_discount_percentage FROM ({LINES}) GROUP BY product_id) b
LEFT JOIN (SELECT product_id, COUNT(*) AS returning_customers FROM (SELECT product_id, customer_id FROM ({LINES})
  GROUP BY ALL HAVING COUNT(DISTINCT transaction_id) > 1) GROUP BY 1) r USING (product_id)
LEFT JOIN product USING (product_id)"""
PRODUCT = PRODUCT.replace("SELECT b.*,", "SELECT b.*, COALESCE(returning_customers, 0) AS returning_customers,")

RANKED = f"""
SELECT *, dense_rank() OVER (PARTITION BY category_level1 ORDER BY gross_revenue DESC) AS category_revenue_rank,
  dense_rank() OVER (PARTITION BY category_level1 ORDER BY total_units_sold DESC) AS category_units_rank,
  dense_rank() OVER (ORDER BY gross_revenue DESC) AS overall_revenue_rank FROM ({PRODUCT})"""

REASON = """SELECT product_id, return_reason AS top_return_reason FROM (SELECT product_id, return_reason,
  SUM(return_quantity) AS w FROM item WHERE return_reason IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY w DESC, return_reason) = 1"""

STOCK = f"""
SELECT *, {R("365", "inventory_turnover")} AS days_inventory_outstanding FROM (
SELECT s.*, {R("sold", "avg_inventory_on_hand")} AS inventory_turnover FROM (
  SELECT product_id, {MEAN("quantity_on_hand")} AS avg_inventory_on_hand,
    COUNT(DISTINCT CASE WHEN is_stockout THEN snapshot_date END) AS stockout_days,
    {P("COUNT(*) FILTER (is_stockout)", "COUNT(*)")} AS stockout_rate,
    bool_or(stock_status IN ('low_stock', 'out_of_stock')) FILTER (snapshot_date = last_day) AS requires_reorder
  FROM (SELECT *, MAX(snapshot_date) OVER (PARTITION BY product_id) AS last_day FROM stock) GROUP BY product_id) s
LEFT JOIN (SELECT product_id, SUM(net_quantity) AS sold FROM item GROUP BY 1) USING (product_id))"""

VELOCITY = f"""
SELECT product_id, {R("ru", "90")} AS units_per_day, {R("rr", "90")} AS revenue_per_day,
  {G("rr", "er")} AS revenue_growth_rate, {G("ru", "eu")} AS volume_growth_rate, t AS sales_velocity_trend,
  t = 'up' AS is_trending, COALESCE({G("ru", "eu")} < -50, FALSE) AS is_low_performer
FROM (SELECT *, CASE WHEN ru > eu * 1.1::DOUBLE THEN 'up' WHEN ru < eu * 0.9::DOUBLE THEN 'down' ELSE 'stable' END AS t
FROM (SELECT product_id,
  {N(f"SUM(CASE WHEN transaction_date > {AS_OF} - 90 AND transaction_date <= {AS_OF} THEN net_quantity ELSE 0 END)")} AS ru,
  {N(f"SUM(CASE WHEN transaction_date > {AS_OF} - 180 AND transaction_date <= {AS_OF} - 90 THEN net_quantity ELSE 0 END)")} AS eu,
  {M(f"SUM(CASE WHEN transaction_date > {AS_OF} - 90 AND transaction_date <= {AS_OF} THEN line_total ELSE 0 END)")} AS rr,
  {M(f"SUM(CASE WHEN transaction_date > {AS_OF} - 180 AND transaction_date <= {AS_OF} - 90 THEN line_total ELSE 0 END)")} AS er
FROM ({LINES}) GROUP BY product_id))"""

HELD = "SELECT DISTINCT transaction_id, product_id FROM item"

MARKET = f"""
SELECT p.product_id, {P("gross_revenue", "SUM(gross_revenue) OVER (PARTITION BY category_level1)")} AS category_market_share,
  {P("total_customers", "(SELECT COUNT(DISTINCT customer_id) FROM txn)")} AS penetration_rate,
  {P("returning_customers", "total_customers")} AS repeat_purchase_rate,
  {R("total_units_sold", "total_customers")} AS avg_units_per_customer, basket_attachment_rate, avg_basket_size_with_product
FROM ({PRODUCT}) p LEFT JOIN (SELECT product_id, {P("COUNT(*) FILTER (n > 1)", "COUNT(*)")} AS basket_attachment_rate,
  {MEAN("n")} AS avg_basket_size_with_product FROM ({HELD}) JOIN (SELECT transaction_id, COUNT(*) AS n FROM ({HELD})
  GROUP BY 1) USING (transaction_id) GROUP BY 1) USING (product_id)"""

ELASTIC = f"""
SELECT product_id, COUNT(*) AS months, CASE WHEN COUNT(*) >= 3 AND MAX(x) > MIN(x) THEN ROUND(regr_slope(y, x), 4) END
  AS price_elasticity_coefficient
FROM (SELECT product_id, ROUND(ln({R("SUM(line_subtotal - line_discount)", "SUM(quantity)")}), 6) AS x,
  ROUND(ln(CAST(SUM(quantity) AS DOUBLE)), 6) AS y FROM ({LINES}) GROUP BY product_id, date_trunc('month', transaction_date)
  HAVING SUM(quantity) > 0 AND SUM(line_subtotal - line_discount) > 0) GROUP BY product_id"""

PAIRS = f"""SELECT a.product_id AS item_a, b.product_id AS item_b, COUNT(*) AS transactions_with_both,
  SUM(total_amount) AS amount_both FROM ({HELD}) a JOIN ({HELD}) b
  ON a.transaction_id = b.transaction_id AND a.product_id < b.product_id
  JOIN txn ON txn.transaction_id = a.transaction_id GROUP BY 1, 2"""

PARTNERS = f"""
SELECT x AS item, string_agg(CAST(y AS VARCHAR), ',' ORDER BY r) AS partners FROM (
  SELECT *, row_number() OVER (PARTITION BY x ORDER BY n DESC, y) AS r FROM (
    SELECT item_a AS x, item_b AS y, transactions_with_both AS n FROM ({PAIRS})
    UNION ALL SELECT item_b, item_a, transactions_with_both FROM ({PAIRS})))
WHERE r <= 3 GROUP BY x"""

GOLD_PRODUCT = f"""
WITH r AS ({RANKED}), rs AS ({REASON}), st AS ({STOCK}), ve AS ({VELOCITY}), ma AS ({MARKET}), el AS ({ELASTIC}), pa AS ({PARTNERS})
SELECT row_number() OVER (ORDER BY gross_revenue DESC, r.product_id) AS product_key, r.product_id, {AS_OF} AS analysis_date,
  'monthly' AS time_period, product_name, category_level1, category_level2, brand, total_units_sold, total_transactions,
  total_customers, new_customers, repeat_customers, gross_revenue, net_revenue, total_discounts,
  {d2(10, "avg_selling_price")}, {d2(5, "avg_discount_percentage")}, total_cost, gross_profit,
  {d2(12, "gross_margin_percentage")}, contribution_margin, units_returned, {d2(5, "return_rate")}, return_value,
  top_return_reason, {d2(18, "avg_inventory_on_hand", "inventory_turnover", "days_inventory_outstanding", "revenue_per_day",
    "avg_units_per_customer", "avg_basket_size_with_product", "revenue_growth_rate", "volume_growth_rate")},
  stockout_days, {d2(5, "stockout_rate", "category_market_share", "penetration_rate", "repeat_purchase_rate",
    "basket_attachment_rate")}, {d2(10, "units_per_day")}, sales_velocity_trend, category_revenue_rank,
  category_units_rank, overall_revenue_rank,
  CAST(price_elasticity_coefficient AS DECIMAL(8,4)) AS price_elasticity_coefficient,
  {nulls("DECIMAL(10,2)", "optimal_price_point", "market_share_change")}, partners AS top_cross_sell_products, is_trending,
  {nulls("BOOLEAN", "is_seasonal")}, is_low_performer, category_revenue_rank <= 10 AS is_high_performer, requires_reorder
FROM r LEFT JOIN rs USING (product_id) LEFT JOIN st USING (product_id) LEFT JOIN ve USING (product_id)
  LEFT JOIN ma USING (product_id) LEFT JOIN el USING (product_id) LEFT JOIN pa ON pa.item = r.product_id"""

# --- categories ---

LEVELS = "category_level1, category_level2, category_level3, brand"


MEAN_T = R("ta", "tn")
CATLINES = f"SELECT l.*, {LEVELS} FROM ({LINES}) l LEFT JOIN product USING (product_id)"


def category_base(unit: str) -> str:
    return f"""
SELECT l.*, {MEAN_T} AS avg_transaction_value FROM (
SELECT CAST(date_trunc('{unit}', transaction_date) AS DATE) AS period_date, {LEVELS}, {M("SUM(line_total)")} AS total_revenue,
  {N("SUM(net_quantity)")} AS total_units_sold, COUNT(DISTINCT transaction_id) AS total_transactions,
  COUNT(DISTINCT customer_id) AS unique_customers,
  COUNT(DISTINCT CASE WHEN is_first_purchase THEN customer_id END) AS new_customers,
  COUNT(DISTINCT CASE WHEN NOT is_first_purchase THEN customer_id END) AS repeat_customers,
  {R("SUM(net_quantity)", "COUNT(DISTINCT transaction_id)")} AS avg_units_per_transaction,
  {MEAN("unit_price")} AS avg_price_point, {M("SUM(net_line_revenue - line_cost)")} AS total_profit,
  {P("SUM(net_line_revenue - line_cost)", "SUM(net_line_revenue)")} AS profit_margin_percentage,
  {MEAN("discount_percentage")} AS avg_discount_percentage,
  {P("SUM(CASE WHEN discount_percentage > 0 THEN line_total ELSE 0 END)", "SUM(line_total)")} AS promotional_sales_percentage
FROM ({CATLINES}) GROUP BY 1, 2, 3, 4, 5) l
JOIN (SELECT CAST(date_trunc('{unit}', transaction_date) AS DATE) AS period_date, {LEVELS}, SUM(total_amount) AS ta, COUNT(*) AS tn
  FROM (SELECT DISTINCT transaction_id, transaction_date, total_amount, {LEVELS} FROM ({CATLINES})) GROUP BY 1, 2, 3, 4, 5) t
USING (period_date, {LEVELS})"""


MONTHLY = category_base("month")

def shares(unit: str) -> str:
    return f"""SELECT *, {P("total_revenue", "SUM(total_revenue) OVER (PARTITION BY period_date, category_level1)")}
  AS category_revenue_percentage,
  {P("total_revenue", "SUM(total_revenue) OVER (PARTITION BY period_date, category_level1, brand)")}
  AS brand_revenue_percentage FROM ({category_base(unit)})"""


SHARES = shares("month")


def before(back: str, alias: str) -> str:
    same = " AND ".join(f"{alias}.{c} = b.{c}" for c in LEVELS.split(", "))
    return f"LEFT JOIN b {alias} ON {same} AND {alias}.period_date = CAST(b.period_date - INTERVAL {back} AS DATE)"


NO_GROWTH = "CAST(NULL AS DOUBLE)"


def growth(unit: str) -> str:
    week, month = unit == "week", unit == "month"
    joins = before("7 DAY", "w") if week else before("1 MONTH", "m") + " " + before("12 MONTH", "y") if month else ""
    return f"""
WITH b AS ({shares(unit)})
SELECT b.*, {G("b.total_revenue", "w.total_revenue") if week else NO_GROWTH} AS revenue_growth_wow,
  {G("b.total_revenue", "m.total_revenue") if month else NO_GROWTH} AS revenue_growth_mom,
  {G("b.total_revenue", "y.total_revenue") if month else NO_GROWTH} AS revenue_growth_yoy,
  {G("b.total_units_sold", "y.total_units_sold") if month else NO_GROWTH} AS units_growth_yoy
FROM b {joins}"""


GROWTH = growth("month")

PRICE_INDEX = P("avg_price_point", """(CAST(SUM(CAST(avg_price_point AS DECIMAL(20,6))) OVER (PARTITION BY category_level1) AS DOUBLE)
  / COUNT(avg_price_point) OVER (PARTITION BY category_level1))""")


def full(unit: str) -> str:
    return f"""
SELECT g.*, {P("unique_customers", "pc")} AS customer_penetration_rate,
  {P("new_customers", "unique_customers")} AS new_customer_percentage,
  {P("repeat_customers", "unique_customers")} AS repeat_customer_rate, {PRICE_INDEX} AS price_index,
  dense_rank() OVER (PARTITION BY category_level1, period_date ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank_in_category,
  dense_rank() OVER (PARTITION BY category_level1, period_date ORDER BY total_units_sold DESC NULLS LAST) AS units_rank_in_category,
  dense_rank() OVER (PARTITION BY category_level1, period_date ORDER BY revenue_growth_yoy DESC NULLS LAST) AS growth_rank_in_category
FROM ({growth(unit)}) g
LEFT JOIN (SELECT CAST(date_trunc('{unit}', transaction_date) AS DATE) AS period_date, COUNT(DISTINCT customer_id) AS pc FROM txn GROUP BY 1)
  USING (period_date)"""


FULL = full("month")

UNITS = {"daily": "day", "weekly": "week", "monthly": "month", "quarterly": "quarter", "yearly": "year"}


def gold_category(name: str) -> str:
    stored = {"revenue_growth_wow": "weekly", "revenue_growth_mom": "monthly", "revenue_growth_yoy": "monthly", "units_growth_yoy": "monthly"}
    grown = [D(f"COALESCE({n}, 0)", 12, 2) if grain == name else "CAST(NULL AS DECIMAL(12,2))" for n, grain in stored.items()]
    return f"""
SELECT {AS_OF} AS analysis_date, '{name}' AS time_period, period_date, {LEVELS}, total_revenue, total_units_sold,
  total_transactions, unique_customers, {d2(10, "avg_transaction_value", "avg_price_point")},
  {d2(12, "avg_units_per_transaction", "profit_margin_percentage", "price_index")}, total_profit,
  {d2(5, "category_revenue_percentage", "brand_revenue_percentage", "customer_penetration_rate", "new_customer_percentage",
    "repeat_customer_rate", "avg_discount_percentage", "promotional_sales_percentage")},
  {", ".join(f"{value} AS {n}" for n, value in zip(stored, grown))},
  revenue_rank_in_category, units_rank_in_category, growth_rank_in_category FROM ({full(UNITS[name])})"""


GOLD_CATEGORY = " UNION ALL ".join(gold_category(name) for name in UNITS)

CKEYS = f"period_date, {LEVELS}"


def periods() -> str:
    parts = []
    for name, unit in UNITS.items():
        growth = G("b.total_revenue", "w.total_revenue") if name == "weekly" else "CAST(NULL AS DOUBLE)"
        join = before("7 DAY", "w") if name == "weekly" else ""
        parts.append(f"""SELECT '{name}' AS time_period, b.period_date, {", ".join("b." + c for c in LEVELS.split(", "))},
  b.total_revenue, b.total_units_sold, b.total_transactions, b.unique_customers, {growth} AS revenue_growth_wow
FROM b_{unit} b {join.replace("LEFT JOIN b ", f"LEFT JOIN b_{unit} ")}""")
    ctes = ", ".join(f"b_{unit} AS ({category_base(unit)})" for unit in UNITS.values())
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


# --- baskets ---

def rules(held: str) -> str:
    """Association rules over (transaction_id, thing) rows."""
    return f"""
SELECT item_a, item_b, transactions_with_both, transactions_with_a, transactions_with_b, total_transactions,
  CAST(transactions_with_both AS DOUBLE) / total_transactions AS support,
  CAST(transactions_with_both AS DOUBLE) / transactions_with_a AS confidence_a_to_b,
  CAST(transactions_with_both AS DOUBLE) / transactions_with_b AS confidence_b_to_a,
  CAST(transactions_with_both AS DOUBLE) * total_transactions / (CAST(transactions_with_a AS DOUBLE) * transactions_with_b) AS lift,
  {D(R("amount_both", "transactions_with_both"), 12, 2)} AS avg_basket_value_with_both,
  {D(R("amount_a - amount_both", "transactions_with_a - transactions_with_both"), 12, 2)} AS avg_basket_value_with_a_only
FROM (SELECT a.thing AS item_a, b.thing AS item_b, COUNT(*) AS transactions_with_both, SUM(a.total_amount) AS amount_both
  FROM ({held}) a JOIN ({held}) b ON a.transaction_id = b.transaction_id AND a.thing < b.thing GROUP BY 1, 2) p
JOIN (SELECT thing AS item_a, COUNT(*) AS transactions_with_a, SUM(total_amount) AS amount_a FROM ({held}) GROUP BY 1) USING (item_a)
JOIN (SELECT thing AS item_b, COUNT(*) AS transactions_with_b FROM ({held}) GROUP BY 1) USING (item_b)
CROSS JOIN (SELECT COUNT(*) AS total_transactions FROM txn)"""


def scored(held: str) -> str:
    gain = "greatest(COALESCE(CAST(avg_basket_value_with_both - avg_basket_value_with_a_only AS DOUBLE), 0), 0)"
    score = f"lift * 20 + confidence_a_to_b * 50 + support * 1000 + {gain} * CAST(0.1 AS DOUBLE)"
    return f"""
SELECT *, avg_basket_value_with_both - avg_basket_value_with_a_only AS incremental_basket_value,
  CASE WHEN transactions_with_both < transactions_with_a
    THEN (1 - CAST(transactions_with_b AS DOUBLE) / total_transactions) / (1 - confidence_a_to_b) END AS conviction,
  {D(score, 20, 2)} AS recommendation_score,
  lift > 1.5 AND confidence_a_to_b > 0.3 AND transactions_with_both >= 3 AS is_strong_association FROM ({rules(held)})"""

PARTS = "SELECT DISTINCT transaction_id, product_id AS thing, total_amount FROM item JOIN txn USING (transaction_id)"

GOLD_BASKET = f"""
SELECT {AS_OF} AS analysis_date, item_a AS product_id_a, item_b AS product_id_b, a.product_name AS product_name_a,
  b.product_name AS product_name_b, a.category_level1 AS category_a, b.category_level1 AS category_b, transactions_with_a,
  transactions_with_b, transactions_with_both, total_transactions, support, confidence_a_to_b, confidence_b_to_a,
  lift, conviction, avg_basket_value_with_both, avg_basket_value_with_a_only, incremental_basket_value, recommendation_score,
  is_strong_association
FROM ({scored(PARTS)}) LEFT JOIN product a ON item_a = a.product_id LEFT JOIN product b ON item_b = b.product_id"""

STATEMENTS = {
    "join_left_dim": """SELECT transaction_id, product_id, quantity, line_total, product_name, category_level1
FROM item LEFT JOIN product USING (product_id)""",
    "join_star_inner": f"""SELECT category_level1, brand, channel, COUNT(*) AS lines, {M("SUM(line_total)")} AS revenue,
  {N("SUM(net_quantity)")} AS units FROM item JOIN product USING (product_id) JOIN txn USING (transaction_id) GROUP BY 1, 2, 3""",
    "orphan_items": f"""SELECT COUNT(*) AS orphan_lines, COUNT(DISTINCT product_id) AS orphan_products,
  {M("SUM(line_total)")} AS orphan_revenue FROM item WHERE product_id % 10 = 3""",
    "product_base_metrics": PRODUCT,
    "return_rate": f"SELECT product_id, total_units_sold, units_returned, return_rate FROM ({PRODUCT})",
    "product_rank": f"""SELECT product_id, category_level1, gross_revenue, category_revenue_rank, category_units_rank,
  overall_revenue_rank FROM ({RANKED})""",
    "high_performers": f"SELECT product_id, category_level1, category_revenue_rank FROM ({RANKED}) WHERE category_revenue_rank <= 10",
    "product_economics": f"""SELECT product_id, total_discounts, total_cost, contribution_margin, return_value,
  category_units_rank, top_return_reason FROM ({RANKED}) LEFT JOIN ({REASON}) USING (product_id)""",
    "inventory_turnover": STOCK,
    "sales_velocity": VELOCITY,
    "product_market": MARKET,
    "price_elasticity": ELASTIC,
    "cross_sell_top3": PARTNERS,
    "gold_product_performance": GOLD_PRODUCT,
    "category_base": MONTHLY,
    "category_periods": periods(),
    "market_share": f"SELECT {CKEYS}, total_revenue, category_revenue_percentage, brand_revenue_percentage FROM ({SHARES})",
    "growth_mom": f"SELECT {CKEYS}, revenue_growth_mom FROM ({GROWTH})",
    "growth_yoy": f"SELECT {CKEYS}, revenue_growth_yoy, units_growth_yoy FROM ({GROWTH})",
    "customer_penetration": f"""SELECT {CKEYS}, customer_penetration_rate, new_customer_percentage, repeat_customer_rate
FROM ({FULL})""",
    "price_index": f"SELECT {CKEYS}, avg_price_point, {PRICE_INDEX} AS price_index FROM ({MONTHLY})",
    "promo_share": f"SELECT {CKEYS}, promotional_sales_percentage, avg_discount_percentage FROM ({MONTHLY})",
    "category_rankings": f"""SELECT {CKEYS}, revenue_rank_in_category, units_rank_in_category, growth_rank_in_category
FROM ({FULL})""",
    "gold_category_brand": GOLD_CATEGORY,
    "topk_categories": f"""SELECT category_level1, brand, {M("SUM(total_revenue)")} AS revenue,
  {MEAN("CAST(COALESCE(revenue_growth_yoy, 0) AS DECIMAL(20,6))")} AS avg_yoy_growth,
  MAX(revenue_rank_in_category) AS best_rank FROM ({FULL}) GROUP BY 1, 2 ORDER BY revenue DESC, 1, 2 LIMIT 10""",
    "growth_leaders": f"""SELECT {CKEYS}, total_revenue, revenue_growth_yoy, growth_rank_in_category FROM ({FULL})
WHERE revenue_growth_yoy > 0 ORDER BY revenue_growth_yoy DESC, {LEVELS}, period_date LIMIT 10""",
    "basket_pairs": f"SELECT item_a, item_b, transactions_with_both FROM ({PAIRS})",
    "association_rules": f"""SELECT item_a, item_b, transactions_with_both, transactions_with_a, transactions_with_b,
  total_transactions, support, confidence_a_to_b, confidence_b_to_a, lift, conviction FROM ({scored(PARTS)})""",
    "basket_incremental_value": f"""SELECT item_a, item_b, avg_basket_value_with_both, avg_basket_value_with_a_only,
  incremental_basket_value FROM ({scored(PARTS)})""",
    "recommendation_score": f"SELECT item_a, item_b, recommendation_score FROM ({scored(PARTS)})",
    "strong_associations": f"""SELECT item_a, item_b, lift, confidence_a_to_b, is_strong_association FROM ({scored(PARTS)})""",
    "topk_associations": f"""SELECT item_a, item_b, recommendation_score, lift FROM ({scored(PARTS)})
WHERE is_strong_association ORDER BY recommendation_score DESC, item_a, item_b LIMIT 10""",
    "basket_summary": f"""SELECT COUNT(*) AS total_pairs, COUNT(*) FILTER (is_strong_association) AS strong_pairs,
  {MEAN("CAST(lift AS DECIMAL(30,6))")} AS avg_lift, MAX(lift) AS max_lift FROM ({scored(PARTS)})""",
    "gold_basket": GOLD_BASKET,
    "agg_global": f"""SELECT {M("SUM(line_subtotal)")} AS total_subtotal, {M("SUM(line_discount)")} AS total_discount,
  {M("SUM(line_tax)")} AS total_tax, {M("SUM(line_total)")} AS total_revenue, {M("SUM(line_cost)")} AS total_cost,
  {M("SUM(line_profit)")} AS total_profit, {MEAN("line_margin_percentage")} AS avg_margin_pct FROM item""",
}
