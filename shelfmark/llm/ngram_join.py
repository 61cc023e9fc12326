"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Two documents link when the Jaccard similarity of their sets of n-gram hashes reaches a
threshold. Overlaps are accumulated over n-gram columns and pairs are discarded by bounds
that follow from the set sizes:

* In one fixed order of n-grams, two sets that link share one of the first
  ``n - ceil(t * n) + 1`` n-grams of either. Only these columns of the incidence are
  multiplied at first. Frequent n-grams go last in the order, so that common passages are
  hardly ever multiplied. The order comes from a sample and is only a matter of work: the
  bound holds for any order.
* Sizes of linked sets differ by the factor ``t`` at most.

* The first common n-grams of a pair leave the rest of the wanted overlap behind them in
  either set, so that a pair has a certain number of them early in both orders.
* Of a pair, all common n-grams are counted in these columns but for those that lie behind
  the shorter reach of the two, ``ceil(t * n) - 1`` at most; the sum must reach the overlap
  that the threshold asks for, ``ceil(t / (1 + t) * (n + m))``.

Documents with equal sets are one class and are handled once. Columns are first multiplied
with one of their members each, the same one wherever it occurs, and then, where members
of a wide column (``WIDE``) are in different components still, with a few others (``MATES``). This ties
large groups of near copies together with a number of pairs that grows with the entries of
the columns, not with their squares. Then all pairs that could still tie two components are
taken. The overlap of each remaining pair is counted over all n-grams, in blocks of the rows
of one class. Which pairs are tried first is a matter of work: no pair that could tie two
components goes uncounted.

Columns and classes are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import re
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.llm.common import WORD, ascii_lower, map_arrow, pieces
from shelfmark.llm.components import components
from shelfmark.session import cut_lineage

NGRAM = 5
THRESHOLD = Fraction(3, 4)
# One in so many distinct texts is looked at for frequent n-grams; of those found in ``FREQUENT`` of them, the most
# frequent ones are sent to all workers, up to ``FREQUENT_KEPT`` of eight bytes each.
SAMPLED = 8
FREQUENT = 3
FREQUENT_KEPT = 500_000
# Columns of more members are tied together by pairs with a few of them (``MATES``) before all pairs are taken.
WIDE = 32
MATES = 4
# Of the common n-grams that a pair must have in its columns, one in so many must be early in both orders. Any number
# gives the same links: a larger one multiplies fewer columns and leaves more pairs to count.
EARLY = 4
# Bits of the table that tells which texts may be wanted: 8 MB at most, whatever the input.
BITS = 1 << 26
KEPT_WORDS = 300_000

_words = re.compile(WORD).findall
_FACTORS = np.random.default_rng(41).integers(0, 1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sets of n-gram hashes of texts."""

    def __init__(self, n: int = NGRAM) -> None:
        self.n = n
        self.known: dict[str, int] = {}

    def number(self, word: str) -> int:
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        self.known[word] = made = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) | 1
        return made

    def set_of(self, text: str) -> np.ndarray:
        """The sorted distinct hashes; of a text with fewer words than ``n``, the one of the whole sequence."""
        known, number = self.known.get, self.number
        words = np.array([known(w) or number(w) for w in _words(ascii_lower(text))], np.uint64)
        size = min(self.n, len(words))
        if not size:
            return words
        count = len(words) - size + 1
        total = np.full(count, size, np.uint64)
        for k in range(size):
            x = (words[k:count + k] ^ (words[k:count + k] >> np.uint64(32))) * _FACTORS[k % len(_FACTORS)]
            total = (total ^ (x >> np.uint64(29)) ^ x) * np.uint64(0x9E3779B97F4A7C15)
        return np.unique(total ^ (total >> np.uint64(31)))


def frequent_ngrams(df: DataFrame, text_col: str, ngram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, sorted, of frequent n-grams and their frequency classes (1 and up), from a sample of distinct texts."""
    sample = df.filter(F.pmod(F.xxhash64(F.col(f"`{text_col}`")), F.lit(SAMPLED)) == 0).select(F.col(f"`{text_col}`").alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(ngram)
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                found, count = np.unique(np.concatenate([shingler.set_of(t) for t in texts]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], names=["h", "c"])

    counts = map_arrow(sample, run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).filter(F.col("c") >= FREQUENT)
    rows = counts.orderBy(F.desc("c"), "h").limit(FREQUENT_KEPT).toPandas()
    hashes = rows["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.log2(rows["c"].to_numpy(float)[order]).astype(np.int64)


def digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def prefix_size(n: int, threshold: Fraction) -> int:
    return n - math.ceil(threshold * n) + 1


def incidence(df: DataFrame, id_col: str, text_col: str, ngram: int, threshold: Fraction) -> DataFrame:
    """(id, digest, n, key, columns): digest of the text, set size, class key and the hashes of the first n-grams in the order; no columns for a set
    that the same task has given before."""
    frequent, level = frequent_ngrams(df, text_col, ngram)
    sent = df.sparkSession.sparkContext.broadcast((frequent, level))
    text = F.col(f"`{text_col}`")
    source = df.select(F.col(f"`{id_col}`").alias("id"), digest(text).alias("digest"), text.alias("text"))
    schema = T.StructType([source.schema["id"], source.schema["digest"], *T.StructType.fromDDL("n long, `key` long, columns array<long>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rank = sent.value
        shingler = Shingler(ngram)
        given: set[int] = set()
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                sizes, keys, columns = [], [], []
                for text in texts:
                    own = shingler.set_of(text)
                    key = int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)
                    first = own[:0]
                    if len(own) and key not in given:
                        take = prefix_size(len(own), threshold)
                        if len(hot):
                            at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
                            late = np.where(hot[at] == own, rank[at] + 1, 0)
                            first = own[np.argsort(late, kind="stable")[:take]] if late.any() else own[:take]
                        else:
                            first = own[:take]
                        if len(given) > 200_000:
                            given.clear()
                        given.add(key)
                    sizes.append(len(own))
                    keys.append(key)
                    columns.append(first.view(np.int64))
                ends = np.cumsum([0, *map(len, columns)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(columns)))], names=schema.names)

    return map_arrow(source, run, schema)


def shared_columns(rows: DataFrame) -> DataFrame:
    """(h, key, w, mate, mate_w) of columns with two classes or more: every entry, and the column's smallest class as its mate.

    The smallest class itself is not given a row. ``w`` holds the set's size and the place of the
    n-gram in the set's order, see ``_size`` and ``_place``.
    """
    entries = rows.select(F.posexplode("columns").alias("i", "h"), "key", "n").select(
        "h", "key", (F.shiftleft(F.col("n"), 32) + F.col("i")).alias("w"))
    dealt = entries.repartition("h").sortWithinPartitions("h", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None  # column, class, size and place of the first entry of the current column
        last = None  # the last entry: it may be repeated
        for batch in batches:
            h, key, w = (batch.column(i).to_numpy() for i in range(3))
            if not len(h):
                continue
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
            fresh[0] = last != (h[0], key[0])
            last = (h[-1], key[-1])
            opens = np.ones(len(h), bool)
            opens[1:] = h[1:] != h[:-1]
            opens[0] = head is None or head[0] != h[0]
            index = np.maximum.accumulate(np.where(opens, np.arange(len(h)), -1))
            mate, mate_w = key[np.maximum(index, 0)].copy(), w[np.maximum(index, 0)].copy()
            if head is not None:
                mate[index < 0], mate_w[index < 0] = head[1], head[2]
            kept = fresh & ~opens
            if opens.any():
                i = int(np.flatnonzero(opens)[-1])
                head = (h[i], key[i], w[i])
            if kept.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (h, key, w, mate, mate_w)], names=["h", "key", "w", "mate", "mate_w"])

    return map_arrow(dealt, run, "h long, `key` long, w long, mate long, mate_w long")


def _size(w: Column) -> Column:
    return F.shiftright(w, 32)


def _place(w: Column) -> Column:
    return w.bitwiseAND(F.lit((1 << 32) - 1))


def _size_bound(n: Column, m: Column, threshold: Fraction) -> Column:
    return F.lit(threshold.denominator) * F.least(n, m) >= F.lit(threshold.numerator) * F.greatest(n, m)


def _wanted(n: Column, m: Column, threshold: Fraction) -> Column:
    """The overlap from which sets of these sizes link."""
    return F.ceil((n + m) * threshold.numerator / F.lit(threshold.numerator + threshold.denominator))


def _reaches(common: Column, n: Column, m: Column, threshold: Fraction) -> Column:
    """Whether two sets can link that share so many of their columns."""
    beyond = F.ceil(F.greatest(n, m) * threshold.numerator / F.lit(threshold.denominator)) - 1
    return common + beyond >= _wanted(n, m, threshold)


def _early(n: Column, m: Column, threshold: Fraction) -> Column:
    """A number of common n-grams that a pair which links must have early in both orders, see ``_is_early``: a share (``EARLY``) of
    those that it must have in its columns, one at least."""
    beyond = F.ceil(F.greatest(n, m) * threshold.numerator / F.lit(threshold.denominator)) - 1
    return F.greatest(F.lit(1), F.ceil((_wanted(n, m, threshold) - beyond) / F.lit(EARLY)))


def _is_early(w: Column, v: Column, threshold: Fraction) -> Column:
    """Whether an entry can be one of the first ``_early`` common ones: those leave the rest of the wanted overlap behind them."""
    n, m = _size(w), _size(v)
    rest = _wanted(n, m, threshold) - _early(n, m, threshold) + 1
    return (n - _place(w) >= rest) & (m - _place(v) >= rest)


def counted(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose overlap over all n-grams reaches the bound.

    ``sets`` has (key, hashes) of every class of the pairs. Each task streams its rows by ``a``: the set of ``a`` is one
    block row, the sets of its partners follow, and their overlaps are counted together.
    """
    partners = pairs.join(sets.withColumnRenamed("key", "b"), "b").select("a", F.lit(1).alias("part"), "b", "hashes")
    heads = pairs.select("a").distinct().join(sets.withColumnRenamed("key", "a"), "a").select("a", F.lit(0).alias("part"), F.col("a").alias("b"), "hashes")
    dealt = heads.unionByName(partners).repartition("a").sortWithinPartitions("a", "part", "b")
    num, den = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = None, np.zeros(0, np.uint64)
        for batch in batches:
            out = []
            for a, part, b, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                hashes = np.frombuffer(data.as_py(), np.uint64)
                if part == 0:
                    own, block = a, hashes
                elif own == a:
                    at = np.minimum(np.searchsorted(block, hashes), len(block) - 1)
                    overlap = int((block[at] == hashes).sum())
                    if den * overlap >= num * (len(block) + len(hashes) - overlap):
                        out.append((a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=["u", "v"])

    return map_arrow(dealt, run, "u long, v long")


def _maybe_among(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts without most of those whose ``_digest`` is no ``digest`` of the wanted rows, told by a table of ``BITS`` bits."""
    def bit(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(BITS)) + 1

    table = wanted.select(bit("digest").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    at = F.bitmap_bit_position(bit("_digest"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    # The table has BITS / 32768 rows of 4 KB at most, so that it is sent to all.
    return texts.join(F.broadcast(table), F.bitmap_bucket_number(bit("_digest")) == F.col("_part")).filter(
        F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select(*texts.columns)


def _sets(df: DataFrame, rows: DataFrame, pairs: DataFrame, id_col: str, text_col: str, ngram: int) -> DataFrame:
    """(key, hashes) of the classes of the pairs, from the texts of one document digest each."""
    wanted = cut_lineage(pairs.select(F.col("a").alias("_key")).unionByName(pairs.select(F.col("b").alias("_key"))).distinct())
    one = cut_lineage(rows.filter("n > 0").join(wanted, F.col("key") == F.col("_key"), "left_semi").groupBy("key").agg(
        F.min(F.struct("id", "digest")).alias("one")).select("one.*").distinct())
    # One plan at every size: texts meet their digests by a shuffle, also where the digests would fit a broadcast.
    texts = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    texts = _maybe_among(texts.withColumn("_digest", digest(F.col("text"))), one).join(
        one.hint("merge"), F.col("_id").eqNullSafe(one["id"]) & (F.col("_digest") == one["digest"]), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(ngram)
        for batch in batches:
            for _, some in pieces(batch, "text"):
                sets = [shingler.set_of(t) for t in some]
                digests = [int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "hashes"])

    # Rows that repeat id and text give their set again.
    return cut_lineage(map_arrow(texts, run, "`key` long, hashes binary").dropDuplicates(["key"]))


def links(df: DataFrame, rows: DataFrame, id_col: str, text_col: str, ngram: int, threshold: Fraction) -> DataFrame:
    """(u, v): links between classes that give the same components as all links do."""
    columns = cut_lineage(shared_columns(rows))
    members = columns.select("h", "key", "w").unionByName(
        columns.select("h", F.col("mate").alias("key"), F.col("mate_w").alias("w")).distinct())
    n, m = _size(F.col("w")), _size(F.col("mate_w"))
    tried = cut_lineage(columns.filter(_size_bound(n, m, threshold)).groupBy(F.col("mate").alias("a"), m.alias("n"), F.col("key").alias("b"), n.alias("m")).agg(
        F.count("*").alias("c")).filter(_reaches(F.col("c"), F.col("n"), F.col("m"), threshold)).select("a", "b"))
    found = cut_lineage(counted(tried, _sets(df, rows, tried, id_col, text_col, ngram), threshold))
    for wide in (True, False):  # wide columns, then all
        # What can still tie two components: entries of columns that hold members of both.
        root = components(found)
        rooted = members.join(root, members["key"] == root["node"], "left").select("h", "key", "w", F.coalesce("root", "key").alias("root"))
        mixed = rooted.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).filter(
            "low <> high" + (f" AND size > {WIDE}" if wide else "")).select("h")
        rooted = cut_lineage(rooted.join(mixed, "h", "left_semi"))
        if rooted.isEmpty():
            continue
        if wide:
            # A few members of the component that a column has most of, others in each column.
            main = rooted.groupBy("h", "root").count().groupBy("h").agg(F.max_by("root", "count").alias("main"))
            known = rooted.join(main, "h")
            order = [F.xxhash64("h", "key", F.lit(seed)) for seed in range(MATES)]
            mates = known.filter("root = main").groupBy("h").agg(F.array(*[F.min_by(F.struct("key", "w"), o) for o in order]).alias("mates"))
            other = known.filter("root <> main").join(mates, "h").select("key", "w", F.explode("mates").alias("mate"))
            paired = other.select("key", "w", F.col("mate.key").alias("b"), F.col("mate.w").alias("v")).filter(
                _size_bound(_size(F.col("w")), _size(F.col("v")), threshold))
            pairs = paired.select(F.least("key", "b").alias("a"), F.greatest("key", "b").alias("b")).distinct()
        else:
            # Every pair that has enough common columns early in both orders.
            right = rooted.select("h", F.col("key").alias("b"), F.col("w").alias("v"), F.col("root").alias("broot"))
            one, two = _size(F.col("w")), _size(F.col("v"))
            first = rooted.join(right, "h").filter(
                (F.col("key") < F.col("b")) & (F.col("root") != F.col("broot")) & _size_bound(one, two, threshold)
                & _is_early(F.col("w"), F.col("v"), threshold))
            shared = first.groupBy(F.col("key").alias("a"), one.alias("n"), "b", two.alias("m")).agg(F.count("*").alias("c"))
            pairs = shared.filter(F.col("c") >= _early(F.col("n"), F.col("m"), threshold)).select("a", "b")
        pairs = cut_lineage(pairs.join(tried, ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            more = counted(pairs, _sets(df, rows, pairs, id_col, text_col, ngram), threshold)
            found = cut_lineage(found.unionByName(more))
            tried = tried.unionByName(pairs)
    return found


def _rooted(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(id, digest, n, root) of every row, and the component's smallest id; the root of a row without n-grams is null."""
    root = components(found)
    classes = rows.filter("n > 0").groupBy("key").agg(F.min("id").alias("low"))
    labelled = classes.join(root, classes["key"] == root["node"], "left").select("key", "low", F.coalesce("root", "key").alias("root"))
    lowest = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    named = labelled.join(lowest, "root").select(F.col("key").alias("_key"), "root", "component_id")
    own = rows.select("id", "digest", "n", F.when(F.col("n") > 0, F.col("key")).alias("_own"))
    return own.join(named, F.col("_own") == F.col("_key"), "left").select("id", "digest", "n", "root", "component_id")


def join_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                 threshold: Fraction = THRESHOLD) -> DataFrame:
    """One row per document row: the id, ``n_shingles`` and ``component_id``, the smallest id reachable by links.

    Words are compared with A-Z in lower case. Null, empty and wordless texts have no
    n-grams and link with nothing, each its own component. Rows with equal texts are
    linked; repeated ids stay separate rows. A component without any id has a null one.
    """
    rows = cut_lineage(incidence(df, id_col, text_col, ngram, threshold))
    rooted = _rooted(rows, cut_lineage(links(df, rows, id_col, text_col, ngram, threshold)))
    return rooted.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def without_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM,
                        threshold: Fraction = THRESHOLD) -> DataFrame:
    """One row of each component, all columns unchanged: of the rows with the smallest id (null counts as largest), one of
    those with the smallest text digest. Rows without words are no near copies and all stay.
    """
    rows = cut_lineage(incidence(df, id_col, text_col, ngram, threshold))
    rooted = cut_lineage(_rooted(rows, cut_lineage(links(df, rows, id_col, text_col, ngram, threshold))).filter("root IS NOT NULL"))
    low = F.col("id").eqNullSafe(F.col("component_id"))
    chosen = rooted.filter(low).groupBy(F.col("root").alias("_root")).agg(F.min("digest").alias("_digest"))
    judged = rooted.join(chosen, F.col("root") == F.col("_root")).select("id", "digest", (low & (F.col("digest") == F.col("_digest"))).alias("stays"))
    dropped = judged.filter(~F.col("stays")).select(F.col("id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    own = [F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(df.columns)]  # names that clash with none of those below
    row_id = f"_in{df.columns.index(id_col)}"
    keyed = df.select(*own, digest(F.col(f"`{text_col}`")).alias("_key"))

    def same(other: DataFrame) -> Column:
        return F.col(row_id).eqNullSafe(other["_id"]) & (F.col("_key") == other["_digest"])

    kept = keyed.join(dropped, same(dropped), "left_anti")
    # Rows that repeat both id and text are told apart by nothing: one of them stays.
    again = cut_lineage(judged.filter("stays").groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).count().filter(
        "count > 1").select("_id", "_digest"))
    if not again.isEmpty():
        single = kept.join(again, same(again), "left_semi").dropDuplicates([row_id, "_key"])
        kept = kept.join(again, same(again), "left_anti").unionByName(single)
    return kept.select(*[F.col(f"_in{i}").alias(c) for i, c in enumerate(df.columns)])
