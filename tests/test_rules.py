"""Single rules on hand-made rows: ladders, codes, calendar, silver edge cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from shelfmark.functions import calendar, ladders, numbers, text


def one_column(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_codes(spark):
    got = one_column(spark, ["CUST10004", "STR001", "FREESHIP", "", None, "VIP10X7"], "string", text.code_to_id)
    assert got == [10004, 1, None, None, None, 10]


def test_location_type(spark):
    assert one_column(spark, ["STR001", "WH001", None], "string", text.location_type) == ["store", "warehouse", None]


def test_json_strings_and_entries(spark):
    values = ['["A","B"]', "[]", "", None, "not json"]
    assert one_column(spark, values, "string", text.json_strings) == [["A", "B"], [], None, None, None]
    got = one_column(spark, values, "string", lambda c: text.has_entries(text.json_strings(c)))
    assert got == [True, False, False, False, False]


def test_truthy(spark):
    values = ["true", "True", "1", "yes", "Yes", "false", "0", "", None]
    assert one_column(spark, values, "string", text.truthy) == [True] * 5 + [False] * 4


def test_channel_spellings(spark):
    values = [" Store ", "in-store", "Online", "marketplace", None]
    assert one_column(spark, values, "string", text.normalise_channel) == ["in-store", "in-store", "online", "marketplace", None]


def test_category_path_skips_missing_levels(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c"), (None, None, None)], "x string, y string, z string")
    got = [r[0] for r in df.select(text.category_path(F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert got == ["a > b > c", "a > c", None]


def test_escalation_words(spark):
    values = ["Escalated to manager", "URGENT", "asked a Supervisor", "all fine", None]
    assert one_column(spark, values, "string", text.is_escalated) == [True, True, True, False, False]


def test_fiscal_calendar(spark):
    days = [dt.date(2025, 3, 31), dt.date(2025, 4, 1), dt.date(2025, 10, 5), dt.date(2026, 1, 1)]
    assert one_column(spark, days, "date", calendar.fiscal_year) == [2024, 2025, 2025, 2025]
    assert one_column(spark, days, "date", calendar.fiscal_quarter) == [4, 1, 3, 4]


def test_holidays_are_days_of_the_month(spark):
    days = [dt.date(2025, 1, 1), dt.date(2025, 1, 5), dt.date(2025, 7, 4), dt.date(2025, 7, 2), dt.date(2025, 12, 25), None]
    assert one_column(spark, days, "date", calendar.is_holiday) == [True, False, True, False, True, False]


@pytest.mark.parametrize("month", [1, 2, 4, 6, 9, 11, 12])
def test_month_start_for_short_and_long_months(spark, month):
    days = [dt.date(2025, month, 1), dt.date(2025, month, 28)]
    assert one_column(spark, days, "date", calendar.month_start) == [dt.date(2025, month, 1)] * 2


def test_months_apart(spark):
    df = spark.createDataFrame([(dt.date(2025, 2, 1), dt.date(2025, 1, 31)), (dt.date(2026, 1, 1), dt.date(2025, 2, 27))], "a date, b date")
    assert [r[0] for r in df.select(calendar.months_apart(F.col("a"), F.col("b"))).collect()] == [1, 11]


def test_price_tiers(spark):
    values = [Decimal("49.99"), Decimal("50"), Decimal("200"), Decimal("500"), None]
    got = one_column(spark, values, "decimal(10,2)", ladders.price_tier)
    assert got == ["budget", "mid-range", "premium", "luxury", None]


def test_lifecycle(spark):
    df = spark.createDataFrame([(True, 10), (True, 90), (True, 365), (True, 1095), (False, 10)], "a boolean, d int")
    got = [r[0] for r in df.select(ladders.lifecycle_stage(F.col("a"), F.col("d"))).collect()]
    assert got == ["introduction", "growth", "maturity", "decline", "discontinued"]


def test_payment_count_knows_both_yearly_spellings(spark):
    rows = [("monthly", 65), ("quarterly", 95), ("annual", 730), ("annually", 364), ("monthly", 0), ("weekly", 10)]
    df = spark.createDataFrame(rows, "f string, d int")
    got = [r[0] for r in df.select(ladders.payment_count(F.col("f"), F.col("d"))).collect()]
    assert got == [2, 1, 2, 1, 0, 1]


def test_churn_risk_ladder(spark):
    rows = [
        (True, "cancelled", True, 5, 9), (False, "payment_failed", True, 5, 9), (False, "active", False, 5, 9),
        (False, "active", False, None, 9), (False, "active", True, 5, 2), (False, "active", True, 5, 9),
    ]
    df = spark.createDataFrame(rows, "c boolean, s string, a boolean, d int, p int")
    got = [r[0] for r in df.select(ladders.churn_risk(*[F.col(n) for n in "csadp"])).collect()]
    assert got == [Decimal(x) for x in ("1.00", "0.80", "0.70", "0.50", "0.40", "0.20")]


def test_sentiment_and_stock(spark):
    scores = [Decimal("0.50"), Decimal("0.00"), Decimal("-0.01"), None]
    assert one_column(spark, scores, "decimal(3,2)", ladders.sentiment_bucket) == ["Positive", "Neutral", "Negative", "Unknown"]
    df = spark.createDataFrame([(0, 5), (4, 5), (16, 5), (5, 5)], "a int, r int")
    got = [r[0] for r in df.select(ladders.stock_status(F.col("a"), F.col("r"))).collect()]
    assert got == ["out_of_stock", "low_stock", "overstock", "in_stock"]


def test_ratio_and_decimal(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (1.005, 1.0)], "a double, b double")
    got = df.select(numbers.ratio(F.col("a"), F.col("b")), numbers.as_decimal(numbers.ratio(F.col("a"), F.col("b")), 10, 2))
    assert [tuple(r) for r in got.collect()] == [(0.333333, Decimal("0.33")), (None, None), (1.005, Decimal("1.01"))]


def test_decimal_overflow_is_an_error(spark):
    df = spark.createDataFrame([(12345.0,)], "a double")
    assert df.select(numbers.as_decimal(F.col("a"), 7, 2)).first()[0] == Decimal("12345.00")
    with pytest.raises(ArithmeticException):
        df.select(numbers.as_decimal(F.col("a"), 5, 2)).collect()
