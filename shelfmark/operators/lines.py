"""Order lines summed to one row per order and product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import numbers
from shelfmark.session import dealt

# Bytes of the lines' files that one task takes over.
TASK_BYTES = 4 << 20


def by_order_and_product(items: DataFrame) -> DataFrame:
    """The first step of every mart built on lines.

    Lines are spread by (order, product), in as many tasks as their files need. An
    order with a third of all lines therefore never reaches a join as more than
    one row per product. Amounts and discount percentages are summed in cents.
    Catalyst drops the sums a mart does not use.
    """
    returned, price = F.col("return_quantity"), F.col("unit_price")
    cents = lambda amount: F.sum(numbers.cents(amount))
    promoted = F.when(F.col("discount_percentage") > 0, F.col("line_total"))
    return dealt(items, items, TASK_BYTES, "transaction_id", "product_id").groupBy("transaction_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("quantity").alias("gross_units"),
        F.sum("net_quantity").alias("net_units"),
        F.sum(returned).alias("returned_units"),
        F.count_if(returned > 0).alias("returned_lines"),
        cents(price).alias("price_sum"),
        cents(F.col("discount_percentage")).alias("discount_sum"),
        cents(F.col("line_subtotal")).alias("subtotal"),
        cents(F.col("line_discount")).alias("discounts"),
        cents(F.col("line_total")).alias("revenue"),
        F.coalesce(cents(promoted), F.lit(0)).alias("promoted"),
        cents(F.col("net_line_revenue")).alias("net_revenue"),
        cents(F.col("line_cost")).alias("cost"),
        F.sum(numbers.cents(price) * returned).alias("return_value"),
    )


def with_orders(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Sums of ``by_order_and_product`` with the columns of their orders; an order has no more rows than there are products."""
    left, right = (dealt(side, lines, TASK_BYTES, "transaction_id") for side in (lines, orders))
    return left.join(right, "transaction_id")
