"""Invariants of the marts, and equal results under different partition counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"


def run(spark, name):
    return queries()[name](spark, FOLDER)


def test_shares_add_up(spark):
    rows = run(spark, "market_share").groupBy("period_date", "category_level1").agg(
        F.sum("category_revenue_percentage").alias("s")).collect()
    assert rows and all(abs(r.s - 100) < 0.01 for r in rows)


def test_first_cohort_month_keeps_everyone(spark):
    rows = run(spark, "cohort_retention").filter("months_since_first_purchase = 0").collect()
    assert rows and all(r.retention_rate == 100.0 and r.churn_rate == 0.0 for r in rows)


def test_pairs_are_ordered_and_bounded(spark):
    rules = run(spark, "association_rules").collect()
    assert rules
    for r in rules:
        assert r.item_a < r.item_b
        assert r.transactions_with_both <= min(r.transactions_with_a, r.transactions_with_b)


def test_quintiles_differ_by_at_most_one(spark):
    scores = run(spark, "rfm_scores").cache()
    for name in ("recency_score", "frequency_score", "monetary_score"):
        sizes = [r[1] for r in scores.groupBy(name).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_most_recent_customer_has_the_best_recency(spark):
    best = run(spark, "rfm_scores").orderBy("days_since_last_purchase").first()
    assert best.recency_score == 5


def test_intervals_do_not_overlap(spark):
    history = run(spark, "scd2_history")
    assert history.filter("effective_end_date <= effective_start_date").isEmpty()
    open_ones = history.filter("is_current").groupBy("product_id").count().filter("count <> 1")
    assert open_ones.isEmpty()


def test_one_first_purchase_per_customer(spark):
    flags = run(spark, "first_purchase_flag").groupBy("customer_id").agg(F.count_if("is_first_purchase").alias("n"))
    assert flags.filter("n <> 1").isEmpty()


@pytest.mark.parametrize("name", ["rfm_scores", "gold_cohort", "attr_time_decay", "product_rank", "touchpoint_seq", "cross_sell_top3"])
def test_results_do_not_depend_on_partitions(spark, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions in ("1", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(sorted(map(repr, run(spark, name).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
