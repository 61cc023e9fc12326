"""Customer profiles: order history, recency/frequency/monetary scores, baskets, support, subscriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import ladders, numbers, orderkeys
from shelfmark.operators.lines import TASK_BYTES, by_order_and_product, with_orders
from shelfmark.operators.names import numbered, with_name, with_number
from shelfmark.operators.ranking import with_places, with_row_number
from shelfmark.session import cut_lineage, dealt

# Lifetime value factor of the simple prediction, score buckets.
CLV_FACTOR = "1.5"
SCORE_BUCKETS = 5

RECENT_DAYS = (30, 90, 365)
CHANNELS = {"online": "online", "mobile": "mobile", "in-store": "instore", "marketplace": "marketplace"}

# Points that make a loyalty tier.
LOYALTY_TIERS = ((10000, "platinum"), (5000, "gold"), (1000, "silver"))


def since(day: Column, as_of: Column, days: int) -> Column:
    """True inside the last ``days`` days up to and including ``as_of``."""
    return (day > F.date_sub(as_of, days)) & (day <= as_of)


def order_profile(txns: DataFrame, as_of: Column) -> DataFrame:
    """Everything the orders tell about a customer, in one pass.

    Orders are summed by (customer, channel) and then by customer, so the
    primary channel comes out of the same aggregation, and a heavy customer is
    partly summed before every shuffle.
    """
    total, day = F.col("total_amount"), F.col("transaction_date")
    spent = numbers.cents(total)
    # Percentages have six digits; they are summed as whole millionths.
    off = F.round(numbers.percent(F.col("discount_amount"), F.col("subtotal")) * 1000000).cast("bigint")
    sums = {
        "orders": F.count("transaction_id"),
        "revenue": F.sum(spent),
        "priced": F.count(total),
        "discounted": F.count_if(F.col("has_discount")),
        "rows": F.count(F.lit(1)),
        "off": F.sum(F.when(F.col("has_discount"), F.coalesce(off, F.lit(0))).otherwise(0)),
        "earned": F.sum(F.coalesce("loyalty_points_earned", F.lit(0))),
        "redeemed": F.sum(F.coalesce("loyalty_points_redeemed", F.lit(0))),
    }
    for days in RECENT_DAYS:
        inside = since(day, as_of, days)
        sums[f"orders_{days}"] = F.count_if(inside)
        sums[f"revenue_{days}"] = F.sum(F.when(inside, spent).otherwise(0))
    by_channel = cut_lineage(txns.groupBy("customer_id", "channel").agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), *[value.alias(name) for name, value in sums.items()]
    ))
    in_channel = lambda channel: F.sum(F.when(F.col("channel") == channel, F.col("orders")).otherwise(0))
    names = numbered(by_channel.select("channel"), "channel")
    by_channel = with_number(by_channel, names, "channel", "_channel")
    most_used = orderkeys.minor_of(F.min(orderkeys.packed(-F.col("rows"), F.col("_channel"))))
    summed = by_channel.groupBy("customer_id").agg(
        F.min("first_day").alias("first_purchase_date"),
        F.max("last_day").alias("last_purchase_date"),
        *[F.sum(name).alias(name) for name in sums],
        *[in_channel(channel).alias(f"{name}_orders") for channel, name in CHANNELS.items()],
        most_used.alias("_channel"),
    )
    summed = with_name(summed, names, "_channel", "most_used")
    used = sum((F.when(F.col(f"{name}_orders") > 0, 1).otherwise(0) for name in CHANNELS.values()), F.lit(0))
    tier = F.lit("bronze")
    for points, name in reversed(LOYALTY_TIERS):
        tier = F.when(F.col("earned") >= points, name).otherwise(tier)
    orders, revenue = F.col("orders"), numbers.from_cents(F.col("revenue"))
    mean_off = (F.col("off").cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(20,6)")
    return summed.select(
        "customer_id", "first_purchase_date", "last_purchase_date",
        numbers.whole(orders).alias("total_orders"),
        numbers.money(revenue).alias("total_revenue"),
        numbers.ratio(revenue, F.col("priced")).alias("avg_order_value"),
        numbers.whole(F.col("discounted")).alias("orders_with_discount"),
        numbers.ratio(mean_off, F.col("rows")).alias("avg_discount_percentage"),
        F.date_diff(as_of, F.col("last_purchase_date")).alias("days_since_last_purchase"),
        numbers.ratio(F.date_diff(as_of, F.col("first_purchase_date")), orders).alias("purchase_frequency_days"),
        numbers.percent(F.col("discounted"), orders).alias("discount_usage_rate"),
        *[numbers.whole(F.col(f"{name}_orders")).alias(f"{name}_orders") for name in CHANNELS.values()],
        *[numbers.percent(F.col(f"{name}_orders"), orders).alias(f"{name}_order_percentage") for name in CHANNELS.values()],
        numbers.ratio(used, F.lit(len(CHANNELS))).alias("channel_diversity_score"),
        F.col("most_used").alias("primary_channel"),
        *[numbers.whole(F.col(f"orders_{days}")).alias(f"orders_last_{days}d") for days in RECENT_DAYS],
        *[numbers.money(numbers.from_cents(F.col(f"revenue_{days}"))).alias(f"revenue_last_{days}d") for days in RECENT_DAYS],
        numbers.whole(F.col("earned")).alias("total_loyalty_points_earned"),
        numbers.whole(F.col("redeemed")).alias("total_loyalty_points_redeemed"),
        numbers.whole(F.col("earned") - F.col("redeemed")).alias("loyalty_points_balance"),
        tier.alias("loyalty_tier"),
    )


# The functions below pick columns of the profile; Catalyst drops the sums they do not need.

def base_metrics(txns: DataFrame, as_of: Column) -> DataFrame:
    """Order history per customer."""
    return order_profile(txns, as_of).select(
        "customer_id", "first_purchase_date", "last_purchase_date", "total_orders", "total_revenue", "avg_order_value",
        "orders_with_discount", "avg_discount_percentage", "days_since_last_purchase", "purchase_frequency_days",
        "discount_usage_rate",
    )


def channel_mix(txns: DataFrame, as_of: Column) -> DataFrame:
    """Orders and share of orders per channel, and how many of the channels are used."""
    return order_profile(txns, as_of).select(
        "customer_id", "total_orders", *[f"{name}_orders" for name in CHANNELS.values()],
        *[f"{name}_order_percentage" for name in CHANNELS.values()], "channel_diversity_score",
    )


def recent_windows(txns: DataFrame, as_of: Column) -> DataFrame:
    """Orders and revenue of the last 30, 90 and 365 days."""
    return order_profile(txns, as_of).select(
        "customer_id", *[f"orders_last_{days}d" for days in RECENT_DAYS], *[f"revenue_last_{days}d" for days in RECENT_DAYS]
    )


def primary_channel(txns: DataFrame, as_of: Column) -> DataFrame:
    """Channel with the most orders, ties to the first name."""
    return order_profile(txns, as_of).select("customer_id", "primary_channel", "channel_diversity_score")


def loyalty(txns: DataFrame, as_of: Column) -> DataFrame:
    """Points earned, redeemed and left, and the tier the earned points reach."""
    return order_profile(txns, as_of).select(
        "customer_id", "total_loyalty_points_earned", "total_loyalty_points_redeemed", "loyalty_points_balance",
        "loyalty_tier",
    )


def _scores() -> dict[str, tuple[Column, int]]:
    return {
        "recency_score": (-F.col("days_since_last_purchase"), SCORE_BUCKETS),
        "frequency_score": (F.col("total_orders"), SCORE_BUCKETS),
        "monetary_score": (F.col("total_revenue"), SCORE_BUCKETS),
    }


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintiles 1..5 for recency (most recent = 5), order count and revenue, ties by customer id."""
    return with_places(cut_lineage(base), "customer_id", {}, _scores())


def scored_and_keyed(base: DataFrame) -> DataFrame:
    """The three quintiles and the running customer number, in one sort."""
    return with_places(cut_lineage(base), "customer_id", {"customer_key": F.col("customer_id")}, _scores())


def with_segment(scored: DataFrame) -> DataFrame:
    idle = F.col("days_since_last_purchase")
    return scored.withColumn(
        "rfm_segment", ladders.rfm_segment(F.col("recency_score"), F.col("frequency_score"), idle)
    )


def with_predictions(base: DataFrame) -> DataFrame:
    idle = F.col("days_since_last_purchase")
    return base.withColumns(
        {
            "clv_prediction": (F.col("total_revenue") * F.lit(CLV_FACTOR).cast("decimal(2,1)")).cast("decimal(20,2)"),
            "churn_probability": ladders.churn_probability(idle),
            "lifetime_stage": ladders.lifetime_stage(F.col("total_orders"), idle),
        }
    )


def surrogate_keys(customers: DataFrame) -> DataFrame:
    return with_row_number(customers, [F.col("customer_id").asc()], "customer_key")


def customer_products(txns: DataFrame, items: DataFrame) -> DataFrame:
    """Purchases per customer and product: the only frame the item-based profile columns need.

    Grouping by (customer, product) first keeps a heavy customer or a popular
    product from gathering in one task. Every step takes as many tasks as the lines' files need.
    """
    buyers = txns.select("transaction_id", "customer_id", "transaction_date")
    lines = with_orders(by_order_and_product(items), buyers)
    return dealt(lines, items, TASK_BYTES, "customer_id", "product_id").groupBy("customer_id", "product_id").agg(
        F.sum("net_units").alias("units"),
        F.sum("gross_units").alias("gross_units"),
        F.sum("returned_units").alias("returned_units"),
        F.sum("returned_lines").alias("returned_lines"),
        F.sum("return_value").alias("returned_value"),
        F.sum(F.col("net_revenue") - F.col("cost")).alias("profit"),
        F.sum("subtotal").alias("list_value"),
        F.max("transaction_date").alias("last_date"),
    )


def item_profile(bought: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Units, variety, price point, premium share, returns and favourites per customer, in one pass.

    Purchases are summed by (customer, category, brand). Each sum then counts
    three times: as a whole, for its category and for its brand. The last
    grouping finds totals, distinct counts and favourites side by side, so
    nothing has to be counted as DISTINCT or joined again. After the first sum a customer has
    no more rows than there are brands in categories, so both later groupings take place in the customer's task.
    """
    catalog = products.filter("is_current").select("product_id", "category_level1", "brand", "price_tier")
    names = numbered(catalog.select(F.col("category_level1").alias("name")).union(catalog.select("brand")), "name")
    coded = with_number(with_number(catalog, names, "category_level1", "_category"), names, "brand", "_brand")
    spread = lambda df, *keys: dealt(df, bought, TASK_BYTES, *keys)
    rows = spread(bought, "product_id").join(spread(coded, "product_id"), "product_id", "left")
    recent = since(F.col("last_date"), as_of, 365)
    premium = F.col("price_tier").isin("premium", "luxury")
    sums = {
        "units": F.sum("units"),
        "gross_units": F.sum("gross_units"),
        "returned_units": F.sum("returned_units"),
        "returned_lines": F.sum("returned_lines"),
        "returned_value": F.sum("returned_value"),
        "profit": F.sum("profit"),
        "list_value": F.sum("list_value"),
        "products": F.count("product_id"),
        "recent_products": F.count_if(recent),
        "premium_units": F.sum(F.when(premium, F.col("gross_units")).otherwise(0)),
    }
    grouped = spread(rows, "customer_id", "_category", "_brand").groupBy("customer_id", "_category", "_brand").agg(
        *[value.alias(name) for name, value in sums.items()]
    )
    roles = F.array(*[
        F.struct(F.lit(role).alias("role"), value.alias("value"))
        for role, value in (("whole", F.lit(0).cast("bigint")), ("category", F.col("_category")), ("brand", F.col("_brand")))
    ])
    counted = spread(grouped, "customer_id").withColumn("_r", F.explode(roles)).groupBy("customer_id", "_r.role", "_r.value").agg(
        *[F.sum(name).alias(name) for name in sums]
    )
    named = F.col("value").isNotNull()
    of = lambda name: F.sum(F.when(F.col("role") == "whole", F.col(name)))
    kinds = lambda role, also=F.lit(True): F.count_if((F.col("role") == role) & named & also)
    # Most units, then the first name: names are compared by their numbers, which have a fixed width.
    best = lambda role: orderkeys.minor_of(F.min(F.when(
        (F.col("role") == role) & named, orderkeys.packed(-F.col("units"), F.col("value"))
    )))
    found = counted.groupBy("customer_id").agg(
        numbers.whole(of("units")).alias("total_items_purchased"),
        numbers.whole(of("products")).alias("unique_products"),
        kinds("category").alias("unique_categories"),
        kinds("brand").alias("unique_brands"),
        numbers.whole(of("recent_products")).alias("unique_products_purchased_365d"),
        kinds("category", F.col("recent_products") > 0).alias("unique_categories_purchased_365d"),
        numbers.ratio(numbers.from_cents(of("list_value")), of("gross_units")).alias("avg_price_point"),
        numbers.percent(of("premium_units"), of("gross_units")).alias("premium_product_percentage"),
        numbers.whole(of("returned_lines")).alias("total_returns"),
        numbers.percent(of("returned_units"), of("gross_units")).alias("return_rate"),
        numbers.money(numbers.from_cents(of("returned_value"))).alias("total_return_value"),
        numbers.money(numbers.from_cents(of("profit"))).alias("total_profit"),
        best("category").alias("_category"),
        best("brand").alias("_brand"),
    )
    return with_name(with_name(found, names, "_category", "most_purchased_category"), names, "_brand", "most_purchased_brand").drop("_category", "_brand")


def premium_share(bought: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    return item_profile(bought, products, as_of).select("customer_id", "premium_product_percentage")


def favourites(bought: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Category and brand with the most units, ties to the first name."""
    return item_profile(bought, products, as_of).select("customer_id", "most_purchased_category", "most_purchased_brand")


def returns(bought: DataFrame) -> DataFrame:
    """Returned lines, share of returned units and list value of returns per customer."""
    return bought.groupBy("customer_id").agg(
        numbers.whole(F.sum("returned_lines")).alias("total_returns"),
        numbers.percent(F.sum("returned_units"), F.sum("gross_units")).alias("return_rate"),
        numbers.money(numbers.from_cents(F.sum("returned_value"))).alias("total_return_value"),
    )


def monthly_amount(amount: Column, frequency: Column) -> Column:
    """A subscription amount per month."""
    months = F.when(frequency == "quarterly", 3).when(frequency.isin("annual", "annually"), 12).otherwise(1)
    return (amount / months.cast("decimal(2,0)")).cast("decimal(18,6)")


def subscription_profile(subs: DataFrame) -> DataFrame:
    active = F.col("status") == "active"
    per_month = monthly_amount(F.col("subscription_amount"), F.col("billing_frequency"))
    return subs.groupBy("customer_id").agg(
        (F.count_if(active) > 0).alias("has_active_subscription"),
        F.count("subscription_id").alias("subscription_count"),
        F.coalesce(F.sum(F.when(active, per_month)), F.lit(0)).cast("decimal(18,2)").alias("subscription_mrr"),
    )


def support_profile(interactions: DataFrame) -> DataFrame:
    return interactions.groupBy("customer_id").agg(
        F.count("interaction_id").alias("total_support_interactions"),
        numbers.mean(F.col("satisfaction_rating")).alias("avg_satisfaction_rating"),
        F.count_if(~F.col("is_resolved")).alias("unresolved_issues_count"),
    )


def customer_360(
    txns: DataFrame,
    items: DataFrame,
    products: DataFrame,
    subs: DataFrame,
    interactions: DataFrame,
    as_of: Column,
) -> DataFrame:
    """One profile row per customer with at least one transaction."""
    bought = customer_products(txns, items)
    profile = with_segment(with_predictions(scored_and_keyed(order_profile(txns, as_of))))
    for part in (item_profile(bought, products, as_of), subscription_profile(subs), support_profile(interactions)):
        profile = profile.join(part, "customer_id", "left")
    absent = {
        "has_active_subscription": F.lit(False),
        "subscription_count": F.lit(0),
        "subscription_mrr": F.lit(0).cast("decimal(18,2)"),
        "total_support_interactions": F.lit(0),
        "unresolved_issues_count": F.lit(0),
        "total_items_purchased": F.lit(0),
        "total_returns": F.lit(0),
    }
    filled = profile.withColumns({name: F.coalesce(F.col(name), value) for name, value in absent.items()})
    typical_gap = F.round(F.col("purchase_frequency_days")).cast("int")
    return filled.withColumns(
        {
            "analysis_date": as_of,
            "customer_segment": F.col("rfm_segment"),
            "avg_items_per_order": numbers.ratio(F.col("total_items_purchased"), F.col("total_orders")),
            "next_purchase_probability": (F.lit(1).cast("decimal(3,2)") - F.col("churn_probability")).cast("decimal(3,2)"),
            "predicted_next_purchase_date": F.date_add(F.col("last_purchase_date"), typical_gap),
        }
    )
