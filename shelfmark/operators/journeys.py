"""An index of each customer's touches, in which a purchase's journey is a range of numbers.

Touches are numbered within their customer in the order of a journey and stored once, as
sorted pieces of a fixed number of touches. A purchase holds the first and the last number of
its journey, found from one row per active day and one per moment of a purchase: no touch is
compared with a purchase. Only where single touches are wanted do purchases meet pieces,
exactly those that their range covers, whatever number of touches the customer has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.ranking import with_row_number
from shelfmark.session import cut_lineage

PIECE = 512  # touches of a piece
KEY = "customer_id"


def numbered(touches: DataFrame, order: list[Column], moment: str, name: str = "seq") -> DataFrame:
    """Touches with a customer and a moment, numbered from 1 within the customer; written once, since several steps read it."""
    known = touches.filter(F.col(KEY).isNotNull() & F.col(moment).isNotNull())
    return cut_lineage(with_row_number(known, order, name, [KEY]))


def ranges(index: DataFrame, wanted: Column, moment: str, days: int, name: str = "seq") -> DataFrame:
    """The rows of ``index`` that ``wanted`` picks, with ``first`` and ``last``: all touches up to the same moment, at most ``days`` days old.

    The order of the numbers has to put wanted rows behind the others of their moment.
    """
    day = F.date_diff(F.to_date(moment), F.lit("1970-01-01").cast("date"))
    # One row per customer and active day: no more than there are days, however many touches.
    daily = index.groupBy(KEY, day.alias("_day")).agg(F.min(name).alias("_from"))
    back = Window.partitionBy(KEY).orderBy("_day").rangeBetween(-days, Window.currentRow)
    begins = daily.select(KEY, "_day", F.min("_from").over(back).alias("first"))
    picked = index.filter(wanted)
    ends = picked.groupBy(KEY, moment).agg(F.max(name).alias("last"))
    return picked.withColumn("_day", day).join(begins, [KEY, "_day"]).join(ends, [KEY, moment]).drop("_day")


def pieces(index: DataFrame, step: Column, name: str = "seq", size: int = PIECE) -> DataFrame:
    """One row per customer and piece: ``steps``, the sorted array of its touches; every piece but a customer's last is full."""
    piece = F.floor((F.col(name) - 1) / size).alias("_piece")
    held = index.groupBy(KEY, piece).agg(F.array_sort(F.collect_list(F.struct(F.col(name).alias("_at"), step.alias("_step")))).alias("_held"))
    return held.select(KEY, "_piece", F.transform("_held", lambda x: x["_step"]).alias("steps"))


def cuts(purchases: DataFrame, stored: DataFrame, size: int = PIECE) -> DataFrame:
    """Per purchase and piece that its range covers, the covered part of the piece as ``steps``, with the piece's number."""
    lowest, highest = F.floor((F.col("first") - 1) / size), F.floor((F.col("last") - 1) / size)
    spread = purchases.withColumn("_piece", F.explode(F.sequence(lowest, highest)))
    begin = F.greatest(F.col("first") - F.col("_piece") * size, F.lit(1)).cast("int")
    end = F.least(F.col("last") - F.col("_piece") * size, F.lit(size)).cast("int")
    return spread.join(stored, [KEY, "_piece"]).withColumn("steps", F.slice("steps", begin, end - begin + 1))
