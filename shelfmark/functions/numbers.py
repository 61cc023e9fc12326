"""Ratios, percentages and exact decimal conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits every ratio is rounded to before it is stored or compared.
RATIO_DIGITS = 6
# Digits on the way from DOUBLE to DECIMAL.
FIT_DIGITS = 26


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as a rounded DOUBLE; NULL when the denominator is 0."""
    return F.round(F.try_divide(numerator.cast("double"), denominator.cast("double")), RATIO_DIGITS)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; NULL when ``whole`` is 0."""
    return F.round(F.try_divide(part.cast("double") * 100, whole.cast("double")), RATIO_DIGITS)


def growth(current: Column, previous: Column) -> Column:
    """Percentage change from ``previous`` to ``current``."""
    return percent(current - previous, previous)


def mean(value: Column) -> Column:
    """Aggregate: exact sum over count, so the result does not depend on row order."""
    return ratio(F.sum(value), F.count(value))


def mean_when(condition: Column, value: Column) -> Column:
    """Aggregate: ``mean`` over the rows that satisfy ``condition``."""
    return mean(F.when(condition, value))


def as_decimal(value: Column, precision: int, scale: int) -> Column:
    """DOUBLE to DECIMAL through six exact digits; a value that does not fit is an error."""
    return value.cast(f"decimal({FIT_DIGITS},{RATIO_DIGITS})").cast(f"decimal({precision},{scale})")


def money(value: Column, precision: int = 18) -> Column:
    """A two-digit amount wide enough for sums."""
    return value.cast(f"decimal({precision},2)")


def cents(amount: Column) -> Column:
    """A two-digit amount as BIGINT, for sums.

    Sums of DECIMAL(12,2) need more than 18 digits and leave Spark's long-based
    decimal path; sums of cents are plain long additions, and an overflow is an
    error, not a wrong result.
    """
    return (amount * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    """A sum of cents as an amount."""
    return (total.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(20,2)")


def whole(value: Column) -> Column:
    return value.cast("bigint")
