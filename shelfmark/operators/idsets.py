"""Exact sets of whole-number ids that aggregates can unite: a row per 64 ids, one bit each.

An id's word is the row it goes to, its bit the place there. Sets over the same grouping and word
unite by ``bit_or``, in hash aggregates of fixed width that combine before the shuffle, so days can
be united to weeks, months and years without going back to the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD, BIT = "_word", "_bit"


def with_word(df: DataFrame, id_col: str) -> DataFrame:
    """Adds the word to group by and the bit to collect; a null id has a word of its own and no bit."""
    number = F.col(id_col).cast("bigint")
    return df.withColumns({WORD: F.shiftright(number, 6), BIT: F.coalesce(_bit(number.bitwiseAND(F.lit(63))), F.lit(0).cast("bigint"))})


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.cast("int"))


def collected(wanted: Column) -> Column:
    """The set of a group's ids in rows where ``wanted`` is true."""
    return F.bit_or(F.when(wanted, F.col(BIT)).otherwise(F.lit(0).cast("bigint")))


def counted(name: str) -> Column:
    """The number of ids over the words of a group."""
    return F.coalesce(F.sum(F.bit_count(name)), F.lit(0)).cast("bigint")
