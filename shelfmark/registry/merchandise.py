"""Product, category and basket queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfmark.operators import quality
from shelfmark.plans import baskets, categories, products, reports
from shelfmark.registry.customers import as_of, mart
from shelfmark.session import cut_lineage
from shelfmark.sources import shapes


# --- joins ------------------------------------------------------------------

def join_left_dim(spark, folder):
    names = shapes.product_catalog(spark, folder).select("product_id", "product_name", "category_level1")
    lines = shapes.transaction_items(spark, folder).select("transaction_id", "product_id", "quantity", "line_total")
    return lines.join(names, "product_id", "left")


def join_star_inner(spark, folder):
    lines = shapes.transaction_items(spark, folder)
    catalog = shapes.product_catalog(spark, folder).select("product_id", "category_level1", "brand")
    orders = shapes.transactions(spark, folder).select("transaction_id", "customer_id", "channel")
    wide = lines.join(catalog, "product_id").join(orders, "transaction_id")
    return wide.groupBy("category_level1", "brand", "channel").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("line_total").cast("decimal(18,2)").alias("revenue"),
        F.sum("net_quantity").cast("bigint").alias("units"),
    )


def orphan_items(spark, folder):
    """Lines without a catalog row; every tenth product is taken out of the catalog to have some."""
    catalog = shapes.product_catalog(spark, folder).withColumn("is_current", F.col("product_id") % 10 != 3)
    return quality.orphans(shapes.transaction_items(spark, folder), catalog)


# --- products ---------------------------------------------------------------

def sold(spark, folder):
    return products.order_products(shapes.transaction_items(spark, folder), shapes.transactions_flagged(spark, folder))


def base(spark, folder):
    return products.base_metrics(sold(spark, folder), shapes.product_catalog(spark, folder), as_of())


def product_base_metrics(spark, folder):
    return base(spark, folder)


def return_rate(spark, folder):
    return base(spark, folder).select("product_id", "total_units_sold", "units_returned", "return_rate")


def product_rank(spark, folder):
    return products.with_ranks(cut_lineage(base(spark, folder))).select(
        "product_id", "category_level1", "gross_revenue", "category_revenue_rank", "category_units_rank",
        "overall_revenue_rank")


def high_performers(spark, folder):
    return products.with_ranks(cut_lineage(base(spark, folder))).filter("is_high_performer").select(
        "product_id", "category_level1", "category_revenue_rank")


def product_economics(spark, folder):
    return products.economics(base(spark, folder), shapes.transaction_items(spark, folder))


def inventory_turnover(spark, folder):
    return products.stock_position(shapes.inventory_snapshots(spark, folder), base(spark, folder))


def sales_velocity(spark, folder):
    return products.velocity(sold(spark, folder), shapes.product_catalog(spark, folder), as_of())


def product_market(spark, folder):
    return products.market_position(
        sold(spark, folder), shapes.product_catalog(spark, folder), shapes.transactions(spark, folder), as_of())


def price_elasticity(spark, folder):
    return products.price_elasticity(sold(spark, folder))


def cross_sell_top3(spark, folder):
    held = baskets.baskets(shapes.transaction_items(spark, folder), shapes.transactions(spark, folder))
    top = baskets.cross_sell(held)
    return top.select("item", F.array_join("top_cross_sell_products", ",").alias("partners"))


def gold_product_performance(spark, folder):
    rows = products.product_performance(
        shapes.transaction_items(spark, folder), shapes.product_catalog(spark, folder),
        shapes.transactions_flagged(spark, folder), shapes.inventory_snapshots(spark, folder), as_of(),
    )
    return mart(rows, "product_performance").withColumn(
        "top_cross_sell_products", F.array_join("top_cross_sell_products", ",")
    )


# --- categories -------------------------------------------------------------

def period_sales(spark, folder, grains=None):
    catalog = shapes.product_catalog(spark, folder)
    lines = categories.order_lines(shapes.transaction_items(spark, folder), catalog, shapes.transactions_flagged(spark, folder))
    return categories.base(lines, categories.group_names(catalog), grains)


KEYS = ["period_date", *categories.LEVELS]


def category_base(spark, folder):
    return period_sales(spark, folder).drop("time_period", categories.GROUP)


def category_periods(spark, folder):
    rows = period_sales(spark, folder, list(categories.GRAINS))
    return categories.with_growth(rows).select(
        "time_period", *KEYS, "total_revenue", "total_units_sold", "total_transactions", "unique_customers",
        "revenue_growth_wow")


def market_share(spark, folder):
    return categories.with_shares(period_sales(spark, folder)).select(
        *KEYS, "total_revenue", "category_revenue_percentage", "brand_revenue_percentage")


def growth_mom(spark, folder):
    return categories.with_growth(period_sales(spark, folder)).select(*KEYS, "revenue_growth_mom")


def growth_yoy(spark, folder):
    return categories.with_growth(period_sales(spark, folder)).select(
        *KEYS, "revenue_growth_yoy", "units_growth_yoy")


def customer_penetration(spark, folder):
    rows = categories.with_penetration(period_sales(spark, folder), shapes.transactions(spark, folder), ["monthly"])
    return rows.select(*KEYS, "customer_penetration_rate", "new_customer_percentage", "repeat_customer_rate")


def price_index(spark, folder):
    return categories.with_price_index(period_sales(spark, folder)).select(*KEYS, "avg_price_point", "price_index")


def promo_share(spark, folder):
    return period_sales(spark, folder).select(*KEYS, "promotional_sales_percentage", "avg_discount_percentage")


def category_rankings(spark, folder):
    rows = categories.with_rankings(categories.with_growth(period_sales(spark, folder)))
    return rows.select(*KEYS, "revenue_rank_in_category", "units_rank_in_category", "growth_rank_in_category")


def category_mart(spark, folder):
    return categories.category_brand_performance(
        shapes.transaction_items(spark, folder), shapes.product_catalog(spark, folder),
        shapes.transactions_flagged(spark, folder), as_of(),
    )


def gold_category_brand(spark, folder):
    return mart(category_mart(spark, folder), "category_brand_performance")


def topk_categories(spark, folder):
    return categories.top_categories(category_mart(spark, folder))


def growth_leaders(spark, folder):
    return categories.growth_leaders(category_mart(spark, folder))


# --- baskets ----------------------------------------------------------------

def held(spark, folder):
    return baskets.baskets(shapes.transaction_items(spark, folder), shapes.transactions(spark, folder))


def product_rules(spark, folder):
    return baskets.association_rules(held(spark, folder), shapes.transactions(spark, folder))


def basket_pairs(spark, folder):
    return baskets.pair_counts(held(spark, folder)).select("item_a", "item_b", "transactions_with_both")


def association_rules(spark, folder):
    return product_rules(spark, folder).select(
        "item_a", "item_b", "transactions_with_both", "transactions_with_a", "transactions_with_b", "total_transactions",
        "support", "confidence_a_to_b", "confidence_b_to_a", "lift", "conviction")


def basket_incremental_value(spark, folder):
    return product_rules(spark, folder).select(
        "item_a", "item_b", "avg_basket_value_with_both", "avg_basket_value_with_a_only", "incremental_basket_value")


def recommendation_score(spark, folder):
    return product_rules(spark, folder).select("item_a", "item_b", "recommendation_score")


def strong_associations(spark, folder):
    """Strong flag at product level, for every pair."""
    return product_rules(spark, folder).select("item_a", "item_b", "lift", "confidence_a_to_b", "is_strong_association")


def topk_associations(spark, folder):
    return baskets.top_associations(product_rules(spark, folder)).select("item_a", "item_b", "recommendation_score", "lift")


def basket_summary(spark, folder):
    return baskets.basket_summary(product_rules(spark, folder))


def gold_basket(spark, folder):
    rows = baskets.basket_analysis(
        shapes.transactions(spark, folder), shapes.transaction_items(spark, folder), shapes.product_catalog(spark, folder),
        as_of(),
    )
    return mart(rows, "basket_analysis")


def agg_global(spark, folder):
    return reports.item_totals(shapes.transaction_items(spark, folder))


QUERIES = {
    f.__name__: f
    for f in (
        join_left_dim, join_star_inner, orphan_items, product_base_metrics, return_rate, product_rank, high_performers,
        product_economics, inventory_turnover, sales_velocity, product_market, price_elasticity, cross_sell_top3,
        gold_product_performance, category_base, category_periods, market_share, growth_mom, growth_yoy,
        customer_penetration, price_index, promo_share, category_rankings, gold_category_brand, topk_categories,
        growth_leaders, basket_pairs, association_rules, basket_incremental_value, recommendation_score,
        strong_associations, topk_associations, basket_summary, gold_basket, agg_global,
    )
}
