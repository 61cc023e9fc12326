"""Benchmark decontamination by spaced seeds.

A mask keeps some positions of a window of words and ignores the others, so a window
with substituted words at ignored positions still has the hash of the original. For
each mask, the windows of the documents are joined by hash with the windows of the
benchmark; around each hit the two texts are compared word by word along the hit's
alignment. An overlap is a stretch of that alignment with the most points (one for an equal
word, one less for a substituted one) and is reported from ``min_score`` points; so are the best
stretches beside it. Items too short for that many points are wanted whole, by one window each.

The benchmark is sent to the workers in blocks of at most ``block_words`` words, so
what is broadcast has a fixed bound; a larger benchmark means more blocks, each a
pass over the documents, never a larger broadcast. Documents are not shuffled, so no
passage, however common, makes a hot task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.llm.common import map_arrow, pieces

# Kept (1) and ignored (0) positions.
MASKS = ("111111", "1110111", "11011011", "110101011", "1100110101", "10110100101")
MIN_SCORE = 8
# Bound of what is broadcast at once.
BLOCK_WORDS = 1_000_000

words_of = re.compile(r"[^\W_]+").findall


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """(score, start, end) of the best stretch: +1 for an equal word, -1 for another one; the first of equals, and the shortest."""
    total = np.concatenate(([0], np.cumsum(np.where(equal, 1, -1))))
    low = np.minimum.accumulate(total)
    gain = total - low
    end = int(np.argmax(gain))
    start = int(np.flatnonzero(total[:end + 1] == low[end])[-1])
    return int(gain[end]), start, end


def stretches(equal: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(score, start, end) of the best stretch and, left and right of it, of the best ones there, as long as they reach ``least`` points."""
    found, parts = [], [(0, len(equal))]
    while parts:
        begin, end = parts.pop()
        if end - begin < least:
            continue
        score, a, b = best_stretch(equal[begin:end])
        if score >= least:
            found.append((score, begin + a, begin + b))
            parts += [(begin, begin + a), (begin + b, end)]
    return sorted(found, key=lambda s: s[1])


class Seeds:
    """Window hashes of a block of items, by mask, and the comparison around hits."""

    def __init__(self, items: list[tuple], masks: tuple[str, ...], min_score: int) -> None:
        self.min_score = min_score
        self.keys = [key for key, _ in items]
        self.numbers: dict[str, int] = {}
        self.items = [np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text.lower())], np.int32)
                      for _, text in items]
        rng = np.random.default_rng(7)
        self.masks = [np.flatnonzero([c == "1" for c in m]) for m in masks]
        # An item of fewer words than the least score is wanted word for word, as one window.
        short = sorted({len(i) for i in self.items if 0 < len(i) < min_score})
        whole = [None] * len(self.masks) + short
        self.masks += [np.arange(n) for n in short]
        self.factors = rng.integers(1, 1 << 62, size=max(map(len, self.masks)), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.reach = max(*map(len, masks), min_score)
        gap = np.zeros(self.reach, np.int32)
        joined = np.concatenate([x for item in self.items for x in (item, gap)]) if self.items else gap
        owner = np.repeat(np.arange(len(self.items)), [len(i) + self.reach for i in self.items])
        first = np.cumsum([0, *(len(i) + self.reach for i in self.items)])
        self.tables = []
        lengths = np.array([len(i) for i in self.items], np.int64)
        for kept, only in zip(self.masks, whole):
            at, hashes = self.windows(joined, kept)
            if only is not None:
                at, hashes = at[lengths[owner[at]] == only], hashes[lengths[owner[at]] == only]
            order = np.argsort(hashes, kind="stable")
            at = at[order]
            self.tables.append((hashes[order], owner[at], at - first[owner[at]]))

    def windows(self, ids: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows all of whose kept words are benchmark words (number above zero)."""
        n = len(ids) - int(kept[-1])
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        good = ids[:n] > 0
        for k in kept[1:]:
            good &= ids[k:n + k] > 0
        at = np.flatnonzero(good)
        hashes = np.zeros(len(at), np.uint64)
        for factor, k in zip(self.factors, kept):
            word = ids[at + k].astype(np.uint64)
            word = (word ^ (word << np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + (word ^ (word >> np.uint64(29))) * factor
        return at, hashes

    def find(self, texts: list[str]) -> dict[int, set[tuple[int, int, int, int, int]]]:
        """For each text with an overlap: (item, score, equal words, first word, end) of every stretch of every alignment that was hit."""
        get = self.numbers.get
        numbered = [[get(w, 0) for w in words_of(t.lower())] for t in texts]
        sizes = np.array([len(x) + self.reach for x in numbered], np.int64)
        first = np.concatenate(([0], np.cumsum(sizes)))
        ids = np.zeros(first[-1], np.int32)
        for begin, x in zip(first, numbered):
            ids[begin:begin + len(x)] = x
        hits = []
        for kept, (hashes, item, place) in zip(self.masks, self.tables):
            at, own = self.windows(ids, kept)
            left = np.searchsorted(hashes, own, "left")
            count = np.searchsorted(hashes, own, "right") - left
            at, left, count = (x[count > 0] for x in (at, left, count))
            which = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(at, count)
            text = np.searchsorted(first, at, "right") - 1
            hits.append(np.stack([text, item[which], at - first[text] - place[which]], axis=1))
        found: dict[int, set[tuple[int, int, int, int, int]]] = {}
        for text, item, shift in np.unique(np.concatenate(hits), axis=0).tolist() if hits else []:
            own, other = ids[first[text]:first[text + 1] - self.reach], self.items[item]
            begin, end = max(0, shift), min(len(own), shift + len(other))
            equal = own[begin:end] == other[begin - shift:end - shift]
            for score, a, b in stretches(equal, min(self.min_score, len(other))):
                found.setdefault(text, set()).add((item, score, int(equal[a:b].sum()), begin + a, begin + b))
        return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple]]:
    """The items in blocks: whole items, dealt by a hash; the number of blocks follows the number of words."""
    items = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).distinct()
    words = items.agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("n")).first()["n"] or 0
    count = -(-words // block_words) * 2 if words > block_words else 1
    dealt = items.withColumn("_block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    for block in range(count):
        rows = dealt.filter(F.col("_block") == block).select("item", "text").collect()
        yield sorted(((r["item"], r["text"]) for r in rows), key=lambda r: (str(r[0]), r[1]))


def overlaps(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", masks: tuple[str, ...] = MASKS, min_score: int = MIN_SCORE,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per overlap of a document row with a benchmark item: the id, ``item_id``, ``score``, ``n_equal`` words, and the
    overlap's ``start`` and ``end`` in words of letters and digits.

    Every stretch of every alignment that reaches the score is reported, so an item that a document holds
    twice has two rows. An item of fewer words than ``min_score`` is found where it stands word for word.
    Words are compared in lower case. Null and empty texts, and items without words, overlap with nothing.
    Repeated rows are reported each; ids may be null.
    """
    source = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    schema = T.StructType([T.StructField("_id", source.schema["_id"].dataType),
                           T.StructField("item", benchmark.schema[item_col].dataType),
                           *[T.StructField(n, T.LongType()) for n in ("score", "n_equal", "start", "end")]])
    item_type = to_arrow_type(schema["item"].dataType)
    parts = []
    for items in _blocks(benchmark, item_col, item_text_col, block_words):
        sent = df.sparkSession.sparkContext.broadcast((items, masks, min_score))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            seeds = Seeds(*sent.value)
            for batch in batches:
                for piece, texts in pieces(batch, "_text"):
                    ids = piece.column(0)
                    rows = [(t, seeds.keys[i], *of) for t, found in seeds.find(texts).items() for i, *of in sorted(found)]
                    if rows:
                        at, *rest = zip(*rows)
                        columns = [pa.array(v, pa.int64()) for v in rest[1:]]
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(rest[0], item_type), *columns], names=schema.names)

        parts.append(map_arrow(source, run, schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select(F.col("_id").alias(id_col), F.col("item").alias("item_id"), "score", "n_equal", "start", "end")


def without_overlaps(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                     item_text_col: str = "text", masks: tuple[str, ...] = MASKS, min_score: int = MIN_SCORE,
                     block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows without an overlap, all columns unchanged."""
    for items in _blocks(benchmark, item_col, item_text_col, block_words):
        sent = df.sparkSession.sparkContext.broadcast((items, masks, min_score))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            seeds = Seeds(*sent.value)
            for batch in batches:
                for piece, texts in pieces(batch, text_col):
                    clean = np.ones(len(texts), bool)
                    clean[list(seeds.find(texts))] = False
                    yield piece.filter(pa.array(clean))

        df = map_arrow(df, run, df.schema)
    return df
