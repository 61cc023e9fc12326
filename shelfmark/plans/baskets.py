"""Market baskets: pair counts, association rules and what a pair adds to a basket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmark.functions import numbers
from shelfmark.operators.pairing import item_pairs
from shelfmark.operators.partners import top_partners
from shelfmark.session import cut_lineage, dealt

# Bytes of the baskets' files whose pairs one task takes over.
PAIR_BYTES = 1 << 20

# Thresholds of a strong association and weights of the score.
STRONG = {"lift": 1.5, "confidence": 0.3, "count": 3}
LIFT_WEIGHT, CONFIDENCE_WEIGHT, SUPPORT_WEIGHT, INCREMENT_WEIGHT = 20, 50, 1000, 0.1


def baskets(items: DataFrame, txns: DataFrame, item: str = "product_id") -> DataFrame:
    """One row per order and distinct item, with the order's total.

    Written out once: item counts, pair sides and basket sizes all read it, and
    would otherwise each repeat the DISTINCT over all lines.
    """
    totals = txns.select("transaction_id", "total_amount")
    return cut_lineage(
        items.filter(F.col(item).isNotNull()).select("transaction_id", F.col(item).alias("item")).distinct()
        .join(totals, "transaction_id", "left")
    )


def item_stats(held: DataFrame) -> DataFrame:
    return held.groupBy("item").agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("amount"))


def frequent(held: DataFrame, min_count: int) -> DataFrame:
    """Baskets without items that are too rare to be in any pair of ``min_count`` orders (exact pruning)."""
    if min_count <= 1:
        return held
    enough = held.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count).select("item")
    return held.join(enough, "item", "left_semi")


def pair_counts(held: DataFrame, min_count: int = 1) -> DataFrame:
    """Orders and order value per item pair; pairs below ``min_count`` orders are left out."""
    met = item_pairs(frequent(held, min_count), "transaction_id", "item", ["total_amount"])
    # Most pairs are met once or twice, so summing them before they are dealt would only take memory; an order has a pair once.
    counted = dealt(met, held, PAIR_BYTES, "item_a", "item_b").groupBy("item_a", "item_b").agg(
        F.count(F.lit(1)).alias("transactions_with_both"), F.sum("total_amount").alias("amount_both")
    )
    return counted.filter(F.col("transactions_with_both") >= min_count) if min_count > 1 else counted


def association_rules(
    held: DataFrame, txns: DataFrame, min_count: int = 1, strong: dict[str, float] = STRONG
) -> DataFrame:
    """Support, confidence, lift, conviction, value and score per pair."""
    stats = item_stats(held)
    a = stats.select(F.col("item").alias("item_a"), F.col("orders").alias("transactions_with_a"),
                     F.col("amount").alias("amount_a"))
    b = stats.select(F.col("item").alias("item_b"), F.col("orders").alias("transactions_with_b"))
    # A pair is one row by now, so an item has no more rows than there are items.
    counted = pair_counts(held, min_count)
    for side, item in ((a, "item_a"), (b, "item_b")):
        counted = dealt(counted, held, PAIR_BYTES, item).join(dealt(side, held, PAIR_BYTES, item), item)
    orders = txns.agg(F.count(F.lit(1)).alias("n")).scalar()
    both, n_a, n_b = (F.col(f"transactions_with_{name}") for name in ("both", "a", "b"))
    total = F.col("total_transactions")
    ruled = counted.withColumn("total_transactions", orders).withColumns(
        {
            "support": F.try_divide(both.cast("double"), total.cast("double")),
            "confidence_a_to_b": F.try_divide(both.cast("double"), n_a.cast("double")),
            "confidence_b_to_a": F.try_divide(both.cast("double"), n_b.cast("double")),
            "lift": F.try_divide(both.cast("double") * total, n_a.cast("double") * n_b),
        }
    )
    against = 1 - n_b.cast("double") / total
    uncertain = both < n_a
    return with_score(with_increment(
        ruled.withColumn("conviction", F.when(uncertain, against / (1 - F.col("confidence_a_to_b"))))
    ), strong)


def with_increment(ruled: DataFrame) -> DataFrame:
    """Mean value of baskets with both items against baskets with the first but not the second."""
    both = numbers.ratio(F.col("amount_both"), F.col("transactions_with_both"))
    only = numbers.ratio(
        F.col("amount_a") - F.col("amount_both"), F.col("transactions_with_a") - F.col("transactions_with_both")
    )
    return ruled.withColumns(
        {
            "avg_basket_value_with_both": numbers.as_decimal(both, 20, 2),
            "avg_basket_value_with_a_only": numbers.as_decimal(only, 20, 2),
        }
    ).withColumn(
        "incremental_basket_value", F.col("avg_basket_value_with_both") - F.col("avg_basket_value_with_a_only")
    ).drop("amount_both", "amount_a")


def with_score(ruled: DataFrame, thresholds: dict[str, float] = STRONG) -> DataFrame:
    gain = F.greatest(F.coalesce(F.col("incremental_basket_value").cast("double"), F.lit(0.0)), F.lit(0.0))
    score = (
        F.col("lift") * LIFT_WEIGHT + F.col("confidence_a_to_b") * CONFIDENCE_WEIGHT + F.col("support") * SUPPORT_WEIGHT
        + gain * INCREMENT_WEIGHT
    )
    strong = (
        (F.col("lift") > thresholds["lift"]) & (F.col("confidence_a_to_b") > thresholds["confidence"])
        & (F.col("transactions_with_both") >= thresholds["count"])
    )
    return ruled.withColumns(
        {"recommendation_score": numbers.as_decimal(score, 20, 2), "is_strong_association": F.coalesce(strong, F.lit(False))}
    )


def basket_analysis(txns: DataFrame, items: DataFrame, products: DataFrame, as_of, min_count: int = 1) -> DataFrame:
    """One row per product pair, with names and categories."""
    rules = association_rules(baskets(items, txns), txns, min_count)
    catalog = products.filter("is_current")
    for side in ("a", "b"):
        names = catalog.select(
            F.col("product_id").alias(f"product_id_{side}"),
            F.col("product_name").alias(f"product_name_{side}"),
            F.col("category_level1").alias(f"category_{side}"),
        )
        rules = rules.withColumnRenamed(f"item_{side}", f"product_id_{side}").join(names, f"product_id_{side}", "left")
    return rules.withColumn("analysis_date", as_of)


def top_associations(rules: DataFrame, limit: int = 10) -> DataFrame:
    """The strong pairs with the best score."""
    strong = rules.filter("is_strong_association")
    return strong.orderBy(F.col("recommendation_score").desc(), "item_a", "item_b").limit(limit)


def basket_summary(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count(F.lit(1)).alias("total_pairs"),
        F.count_if("is_strong_association").alias("strong_pairs"),
        numbers.mean(F.col("lift").cast("decimal(30,6)")).alias("avg_lift"),
        F.max("lift").alias("max_lift"),
    )


def cross_sell(held: DataFrame, top: int = 3) -> DataFrame:
    """The items that share most orders with each item, best first."""
    listed = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", "partner"))), lambda entry: entry["partner"].cast("string")
    )
    return top_partners(held, top).groupBy("item").agg(listed.alias("top_cross_sell_products"))
