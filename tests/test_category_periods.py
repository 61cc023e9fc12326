"""Sales per period and (category, brand) against plain loops, and the widths of what is dealt on the way."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfmark.plans import categories
from shelfmark.session import dealt

FIRST_DAY = {
    "daily": lambda d: d, "weekly": lambda d: d - timedelta(d.weekday()), "monthly": lambda d: d.replace(day=1),
    "quarterly": lambda d: d.replace(month=(d.month - 1) // 3 * 3 + 1, day=1), "yearly": lambda d: d.replace(month=1, day=1),
}
NAMES = {1: ("A", "x", "y", "b"), 2: ("A", "x", "y", "b"), 3: ("B", None, "y", "b"), 4: (None, None, None, None)}


def made(spark, count=600, seed=3):
    """Orders of few customers and days, several a day; customers may be missing, products may not be in the catalog."""
    rng = random.Random(seed)
    orders = [(i, rng.choice([None, *range(6)]), date(2020, 12, 1) + timedelta(rng.randrange(60)) if rng.random() < 0.95 else None,
               Decimal(rng.randrange(1000)), rng.random() < 0.4) for i in range(count)]
    lines = [(o[0], rng.randrange(1, 7), rng.randrange(1, 5), Decimal(rng.randrange(1, 90)), Decimal(rng.choice([0, 5])))
             for o in orders for _ in range(rng.randrange(1, 5))]
    items = spark.createDataFrame(lines, "transaction_id long, product_id long, net_quantity int, line_total decimal(12,2), discount_percentage decimal(5,2)")
    items = items.withColumns({"net_line_revenue": F.col("line_total"), "line_cost": F.lit("1").cast("decimal(12,2)"), "unit_price": F.lit("2").cast("decimal(10,2)")})
    txns = spark.createDataFrame(orders, "transaction_id long, customer_id long, transaction_date date, total_amount decimal(12,2), is_first_purchase boolean")
    catalog = spark.createDataFrame([(k, True, *v) for k, v in NAMES.items()], "product_id long, is_current boolean, " + ", ".join(f"{n} string" for n in categories.LEVELS))
    return orders, lines, items, txns, catalog


@pytest.mark.parametrize("grains", [["monthly"], ["weekly"], list(categories.GRAINS)])
def test_periods_match_plain_loops(spark, grains):
    orders, lines, items, txns, catalog = made(spark)
    of = {o[0]: o for o in orders}
    groups = defaultdict(list)
    for key, product, units, revenue, off in lines:
        names = tuple(n or "Unknown" for n in NAMES.get(product, [None] * 4))
        for grain in grains if of[key][2] else ():
            groups[grain, FIRST_DAY[grain](of[key][2]), *names].append((key, units, revenue, off))
    want = {}
    for place, held in groups.items():
        there = [of[k] for k in {h[0] for h in held}]
        who = lambda kind, there=there: len({o[1] for o in there if o[1] is not None and kind(o)})
        revenue, promoted = sum(h[2] for h in held), sum(h[2] for h in held if h[3] > 0)
        want[place] = (revenue, sum(h[1] for h in held), len(there), who(lambda o: True), who(lambda o: o[4]), who(lambda o: not o[4]),
                       round(float(sum(o[3] for o in there)) / len(there), 6), round(float(promoted) * 100 / float(revenue), 6))
    got = categories.base(categories.order_lines(items, catalog, txns), categories.group_names(catalog), grains).collect()
    assert len(got) == len(want)
    assert {tuple(r[n] for n in ("time_period", "period_date", *categories.LEVELS)): (
        r["total_revenue"], r["total_units_sold"], r["total_transactions"], r["unique_customers"], r["new_customers"], r["repeat_customers"],
        pytest.approx(r["avg_transaction_value"], abs=2e-6), pytest.approx(r["promotional_sales_percentage"], abs=2e-6)) for r in got} == want


def test_days_are_summed_without_names_and_customers(spark):
    """What is added up over days and periods has a row per group and day, not per customer, and no text but the grain's."""
    _, _, items, txns, catalog = made(spark)
    rows = categories.base(categories.order_lines(items, catalog, txns), categories.group_names(catalog), list(categories.GRAINS))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    summed = [line for line in plan.splitlines() if "Aggregate [" in line and "total_amount" in line]
    keys = [line.split("Aggregate [")[1].split("]")[0] for line in summed]
    assert len(keys) == 2 and not any(name in key for key in keys for name in [*categories.LEVELS, "customer_id", "_word"])


def test_tasks_grow_with_the_files(spark, tmp_path):
    spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).write.parquet(f"{tmp_path}/a b")
    rows = spark.read.parquet(f"{tmp_path}/a b")
    bytes_ = sum(f.stat().st_size for f in (tmp_path / "a b").glob("*.parquet"))
    assert dealt(rows, rows, bytes_ // 40, "id").rdd.getNumPartitions() == -(-bytes_ // (bytes_ // 40))
    assert dealt(rows, rows, bytes_, "id").rdd.getNumPartitions() <= 6
    assert dealt(rows, rows, bytes_ // 40, "id").count() == 60_000
