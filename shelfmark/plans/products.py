"""Product performance: sales, returns, ranks, stock, velocity, market position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import ladders, numbers
from shelfmark.operators.firsts import top_value
from shelfmark.operators.lines import by_order_and_product, with_orders
from shelfmark.operators.ranking import with_dense_rank, with_dense_ranks, with_row_number
from shelfmark.plans.baskets import baskets, cross_sell
from shelfmark.session import cut_lineage

# Category rank of a high performer, days compared for velocity.
HIGH_PERFORMER_RANK = 10
VELOCITY_DAYS = 90
LOW_PERFORMER_GROWTH = -50
UNKNOWN = "Unknown"
NAMES = ["product_name", "category_level1", "category_level2", "brand"]


def order_products(items: DataFrame, txns: DataFrame) -> DataFrame:
    """One row per order and product, with the order's customer, day and size.

    The size is an aggregate joined to the orders, so no line moves for it, and an order of very many products is not gathered.
    """
    lines = by_order_and_product(items)
    sizes = lines.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("size"))
    orders = txns.select("transaction_id", "customer_id", "is_first_purchase", "transaction_date")
    return with_orders(lines, orders.join(sizes, "transaction_id", "left"))


def with_names(by_product: DataFrame, products: DataFrame) -> DataFrame:
    """Catalog names; products missing from the catalog are kept under ``Unknown``."""
    catalog = products.filter("is_current").select("product_id", *NAMES)
    named = by_product.join(catalog, "product_id", "left")
    return named.withColumns({name: F.coalesce(F.col(name), F.lit(UNKNOWN)) for name in NAMES})


def profile(sold: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Sales, returns, velocity and basket measures per product, in one pass.

    Counted through (product, customer) first, so that customers need no DISTINCT
    and no product is one task's work.
    """
    day = F.col("transaction_date")
    recent = (day > F.date_sub(as_of, VELOCITY_DAYS)) & (day <= as_of)
    earlier = (day > F.date_sub(as_of, 2 * VELOCITY_DAYS)) & (day <= F.date_sub(as_of, VELOCITY_DAYS))
    plain = ["lines", "gross_units", "net_units", "returned_units", "price_sum", "discount_sum", "subtotal",
             "discounts", "revenue", "net_revenue", "cost", "return_value", "size"]
    sums = {
        **{name: F.sum(name) for name in plain},
        "orders": F.count(F.lit(1)),
        "attached": F.count_if(F.col("size") > 1),
        **{
            f"{part}_{name}": F.sum(F.when(inside, F.col(name)).otherwise(0))
            for part, inside in (("recent", recent), ("earlier", earlier)) for name in ("net_units", "revenue")
        },
    }
    per_customer = sold.groupBy("product_id", "customer_id").agg(
        *[value.alias(name) for name, value in sums.items()], F.max("is_first_purchase").alias("is_new")
    )
    total = per_customer.groupBy("product_id").agg(
        *[F.sum(name).alias(name) for name in sums],
        F.count("customer_id").alias("total_customers"),
        F.count_if("is_new").alias("new_customers"),
        F.count_if(F.col("orders") > 1).alias("returning_customers"),
    )
    amount = lambda name: numbers.money(numbers.from_cents(F.col(name)))
    margin = numbers.from_cents(F.col("net_revenue") - F.col("cost"))
    units, before = numbers.whole(F.col("recent_net_units")), numbers.whole(F.col("earlier_net_units"))
    taken, taken_before = numbers.from_cents(F.col("recent_revenue")), numbers.from_cents(F.col("earlier_revenue"))
    trend = ladders.trend(units, before)
    customers = F.col("total_customers")
    measured = total.select(
        "product_id",
        numbers.whole(F.col("net_units")).alias("total_units_sold"),
        numbers.whole(F.col("lines")).alias("total_transactions"),
        numbers.whole(F.col("orders")).alias("total_orders"),
        customers, "new_customers", (customers - F.col("new_customers")).alias("repeat_customers"),
        "returning_customers",
        amount("revenue").alias("gross_revenue"),
        amount("net_revenue").alias("net_revenue"),
        amount("discounts").alias("total_discounts"),
        amount("cost").alias("total_cost"),
        numbers.money(margin).alias("gross_profit"),
        numbers.money(margin).alias("contribution_margin"),
        numbers.percent(margin, amount("net_revenue")).alias("gross_margin_percentage"),
        numbers.whole(F.col("returned_units")).alias("units_returned"),
        numbers.percent(F.col("returned_units"), F.col("net_units") + F.col("returned_units")).alias("return_rate"),
        amount("return_value").alias("return_value"),
        numbers.ratio(amount("price_sum"), F.col("lines")).alias("avg_selling_price"),
        numbers.ratio(amount("discount_sum"), F.col("lines")).alias("avg_discount_percentage"),
        numbers.percent(F.col("attached"), F.col("orders")).alias("basket_attachment_rate"),
        numbers.ratio(F.col("size"), F.col("orders")).alias("avg_basket_size_with_product"),
        numbers.percent(F.col("returning_customers"), customers).alias("repeat_purchase_rate"),
        numbers.ratio(F.col("net_units"), customers).alias("avg_units_per_customer"),
        numbers.ratio(units, F.lit(VELOCITY_DAYS)).alias("units_per_day"),
        numbers.ratio(taken, F.lit(VELOCITY_DAYS)).alias("revenue_per_day"),
        numbers.growth(taken, taken_before).alias("revenue_growth_rate"),
        numbers.growth(units, before).alias("volume_growth_rate"),
        trend.alias("sales_velocity_trend"),
        (trend == "up").alias("is_trending"),
        F.coalesce(numbers.growth(units, before) < LOW_PERFORMER_GROWTH, F.lit(False)).alias("is_low_performer"),
    )
    return with_names(measured, products)


MARKET = ["repeat_purchase_rate", "avg_units_per_customer", "basket_attachment_rate", "avg_basket_size_with_product"]
VELOCITY = ["units_per_day", "revenue_per_day", "revenue_growth_rate", "volume_growth_rate", "sales_velocity_trend",
            "is_trending", "is_low_performer"]


def base_metrics(sold: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Sales and returns per product; Catalyst drops the measures left out here."""
    return profile(sold, products, as_of).drop(*MARKET, *VELOCITY)


def velocity(sold: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Daily units and revenue of the last 90 days, growth and trend against the 90 days before."""
    return profile(sold, products, as_of).select("product_id", *VELOCITY)


RANKS = {
    "category_revenue_rank": ("gross_revenue", "category_level1"),
    "category_units_rank": ("total_units_sold", "category_level1"),
    "overall_revenue_rank": ("gross_revenue", None),
}


def with_ranks(metrics: DataFrame) -> DataFrame:
    """Revenue rank in the category and overall, unit rank in the category, high performer flag.

    ``metrics`` is read twice: cut its lineage first when it is expensive.
    """
    ranked = with_dense_ranks(metrics, "product_id", RANKS)
    return ranked.withColumn("is_high_performer", F.col("category_revenue_rank") <= HIGH_PERFORMER_RANK)


def economics(metrics: DataFrame, items: DataFrame) -> DataFrame:
    """Discounts, cost, contribution, returns with their top reason, unit rank in the category."""
    ranked = with_dense_rank(cut_lineage(metrics), "total_units_sold", "category_units_rank", ["category_level1"])
    columns = ["product_id", "total_discounts", "total_cost", "contribution_margin", "return_value"]
    return ranked.select(*columns, "category_units_rank").join(return_reasons(items), "product_id", "left")


def return_reasons(items: DataFrame) -> DataFrame:
    """The reason with the most returned units."""
    return top_value(
        items.select("product_id", "return_reason", "return_quantity"),
        "product_id", "return_reason", "return_quantity", "top_return_reason",
    )


def stock_position(inventory: DataFrame, sold_units: DataFrame) -> DataFrame:
    """Mean stock, stock-out days, turnover and reorder need; days are collapsed before products."""
    needy = F.col("stock_status").isin("low_stock", "out_of_stock")
    by_day = inventory.groupBy("product_id", "snapshot_date").agg(
        F.count(F.lit(1)).alias("snapshots"),
        F.sum("quantity_on_hand").alias("on_hand"),
        F.count_if("is_stockout").alias("stockouts"),
        F.max(needy).alias("needy"),
    )
    stock = by_day.groupBy("product_id").agg(
        numbers.ratio(F.sum("on_hand"), F.sum("snapshots")).alias("avg_inventory_on_hand"),
        F.count_if(F.col("stockouts") > 0).alias("stockout_days"),
        numbers.percent(F.sum("stockouts"), F.sum("snapshots")).alias("stockout_rate"),
        F.max_by("needy", "snapshot_date").alias("requires_reorder"),
    )
    turned = numbers.ratio(F.col("total_units_sold"), F.col("avg_inventory_on_hand"))
    return stock.join(sold_units.select("product_id", "total_units_sold"), "product_id", "left").withColumn(
        "inventory_turnover", turned
    ).withColumn("days_inventory_outstanding", numbers.ratio(F.lit(365), F.col("inventory_turnover"))).drop(
        "total_units_sold"
    )


def with_market_share(metrics: DataFrame, txns: DataFrame) -> DataFrame:
    """Share of the category's revenue and of all buyers. ``metrics`` is read twice."""
    categories = metrics.groupBy("category_level1").agg(F.sum("gross_revenue").alias("_category_revenue"))
    buyers = txns.agg(F.count_distinct("customer_id").alias("n")).scalar()
    return metrics.join(categories, "category_level1", "left").withColumns(
        {
            "category_market_share": numbers.percent(F.col("gross_revenue"), F.col("_category_revenue")),
            "penetration_rate": numbers.percent(F.col("total_customers"), buyers),
        }
    ).drop("_category_revenue")


def market_position(sold: DataFrame, products: DataFrame, txns: DataFrame, as_of: Column) -> DataFrame:
    """Category share, penetration, repeat rate, units per customer, attachment and basket size."""
    shared = with_market_share(cut_lineage(profile(sold, products, as_of).drop(*VELOCITY)), txns)
    return shared.select("product_id", "category_market_share", "penetration_rate", *MARKET)


def price_elasticity(sold: DataFrame) -> DataFrame:
    """Slope of ln(units) on ln(net price) over months; NULL below three months or at a constant price."""
    monthly = sold.groupBy("product_id", F.trunc("transaction_date", "MM").alias("month")).agg(
        F.sum("gross_units").alias("units"),
        numbers.from_cents(F.sum(F.col("subtotal") - F.col("discounts"))).alias("paid"),
    ).filter("units > 0 and paid > 0")
    price = F.round(F.ln(numbers.ratio(F.col("paid"), F.col("units"))), 6)
    points = monthly.select("product_id", price.alias("x"), F.round(F.ln(F.col("units").cast("double")), 6).alias("y"))
    fitted = points.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("months"),
        F.regr_slope("y", "x").alias("slope"),
        (F.max("x") > F.min("x")).alias("moved"),
    )
    slope = F.when((F.col("months") >= 3) & F.col("moved"), F.round("slope", 4))
    return fitted.select("product_id", "months", slope.alias("price_elasticity_coefficient"))


def product_performance(
    items: DataFrame, products: DataFrame, txns: DataFrame, inventory: DataFrame, as_of: Column
) -> DataFrame:
    """One row per sold product."""
    # Written once: profile and elasticity read it, the profile twice.
    sold = cut_lineage(order_products(items, txns))
    metrics = cut_lineage(profile(sold, products, as_of))
    ranked = with_row_number(
        with_market_share(with_ranks(metrics), txns), [F.col("gross_revenue").desc(), F.col("product_id").asc()], "product_key"
    )
    partners = cross_sell(baskets(items, txns)).withColumnRenamed("item", "product_id")
    result = ranked
    for part in (return_reasons(items), stock_position(inventory, metrics), price_elasticity(sold), partners):
        # One row per product is written, so the shuffles behind a part are gone before the next one's.
        result = result.join(cut_lineage(part), "product_id", "left")
    return result.withColumns({"analysis_date": as_of, "time_period": F.lit("monthly")})
