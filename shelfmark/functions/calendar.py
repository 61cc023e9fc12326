"""Calendar and fiscal columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Holidays as month and day.
HOLIDAYS = ((1, 1), (7, 4), (12, 25))

# Fixed value: the fiscal year starts in April, three months after January.
FISCAL_OFFSET_MONTHS = 3


def calendar_parts(ts: Column) -> dict[str, Column]:
    weekday = F.dayofweek(ts)
    return {
        "transaction_year": F.year(ts),
        "transaction_month": F.month(ts),
        "transaction_quarter": F.quarter(ts),
        "transaction_day_of_week": weekday,
        "transaction_hour": F.hour(ts),
        "is_weekend": F.coalesce(weekday.isin(1, 7), F.lit(False)),
    }


def fiscal_year(day: Column) -> Column:
    return F.year(F.add_months(day, -FISCAL_OFFSET_MONTHS))


def fiscal_quarter(day: Column) -> Column:
    return F.quarter(F.add_months(day, -FISCAL_OFFSET_MONTHS))


def is_holiday(day: Column) -> Column:
    hit = F.lit(False)
    for month, dom in HOLIDAYS:
        hit = hit | ((F.month(day) == month) & (F.dayofmonth(day) == dom))
    return F.coalesce(hit, F.lit(False))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_number(day: Column) -> Column:
    """Months on one running scale, so calendar gaps become plain subtraction."""
    return F.year(day) * 12 + F.month(day)


def months_apart(later: Column, earlier: Column) -> Column:
    return (month_number(later) - month_number(earlier)).cast("int")
