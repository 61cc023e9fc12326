"""Two whole numbers in one, ordered as the pair.

``min`` and ``max`` over a struct cannot be kept in a hash aggregate, which sorts the rows instead.
A DECIMAL(38,0) has a fixed width: ``major * 2^64 + minor``, both moved to where they are
not negative, compares as (major, minor) and can be taken apart again.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MAJOR_OFFSET = 1 << 61  # majors lie between -2^61 and 2^61
MINOR_OFFSET, WIDTH = 1 << 63, 1 << 64


def packed(major: Column, minor: Column) -> Column:
    """The key of (major, minor); null where either is."""
    high = major.cast("decimal(19,0)") + F.lit(Decimal(MAJOR_OFFSET))
    low = minor.cast("decimal(19,0)") + F.lit(Decimal(MINOR_OFFSET))
    return (high.cast("decimal(19,0)") * F.lit(Decimal(WIDTH)) + low).cast("decimal(38,0)")


def major_of(key: Column) -> Column:
    return F.call_function("div", key, F.lit(Decimal(WIDTH))).cast("bigint") - MAJOR_OFFSET


def minor_of(key: Column) -> Column:
    return (key % F.lit(Decimal(WIDTH)) - F.lit(Decimal(MINOR_OFFSET))).cast("bigint")


def micros(ts: Column) -> Column:
    """Microseconds of a moment; one without a zone is taken in the session's."""
    return F.unix_micros(ts.cast("timestamp"))


def by_time(ts: Column, number: Column) -> Column:
    """The key of (moment, number)."""
    return packed(micros(ts), number)
