"""Bounded samples of labelled rows, on which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, per_class: dict[int, int],
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(order, text, label) of at most ``per_class[label]`` labelled rows per class, none of the held-out fold.

    Rows are taken by the smallest hash of their id, texts whole. The ids are chosen from the
    labels first, so that the join's broadcast side has at most the sum of ``per_class``
    rows and no text is shuffled before it is chosen. Rows without id or label are left out.
    """
    known = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("label")).filter(
        F.col("_id").isNotNull() & (fold("_id", folds) != held_out))
    ids = [known.filter(F.col("label") == value).groupBy("_id").agg(F.max("label").alias("label"))
           .orderBy(F.xxhash64(F.col("_id"), F.lit(17)), "_id").limit(n) for value, n in per_class.items()]
    chosen = ids[0]
    for more in ids[1:]:
        chosen = chosen.unionByName(more)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "_id").select(
        F.xxhash64(F.col("_id"), F.lit(17)).alias("order"), "text", "label")
    # Ids may repeat among the texts, so the bound is set once more.
    return rows.orderBy("order", F.xxhash64("text")).limit(sum(per_class.values()))
