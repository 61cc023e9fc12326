"""Ranked lexical search: the best documents for each item, by the best position algorithm.

A block of documents has one impact list per term: its documents by falling impact of the term.
For an item, the lists of its terms are read side by side. Each document met is scored whole by
direct accesses to the other lists, which also mark its positions there as seen. The best position
of a list is the end of its unbroken stretch of seen positions; the impacts there, weighted
and summed, bound every document not met yet. Direct accesses push best positions beyond
the last position read, so the bound falls faster than one taken at the reading depth. Reading
ends only when the bound is strictly below the kth best score, since an equal score could win by
its id.

The impact of a posting does not depend on the item (its weight is a factor per term), so one
index serves all items. Only terms that may stand in an item get postings: a table of bits of
fixed size drops the others before anything is shuffled, and the join by the term itself makes
that exact. Documents are indexed in blocks and items dealt into packs of bounded size; each
pack meets each block once, as one row of a join, and the best of each block are merged.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import TextFunction, map_arrow, map_texts
from shelfmark.session import cut_lineage

# What no term holds, as a pattern's class; every other byte of UTF-8 belongs to a term, with A-Z in lower case.
SEPARATORS = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()

SLOTS = 1 << 20  # of the table that drops words of no item, one byte each
BLOCK_POSTINGS = 1_000_000  # of a block of documents, and those of one document more
PACK_ITEMS = 256  # items of a pack, on average
MOST_TASKS = 20_000  # of the join of packs with blocks; beyond it a task gets several pairs
FIRST_READ = 16  # positions of each list read at first; each further round reads twice as many

BLOCK = "part int, doc_ids array<bigint>, ends binary, terms array<string>, codes binary, impacts binary"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order."""
    return text.encode().translate(_BYTES).split()


def _term_sets(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    def make() -> TextFunction:
        def run(texts: list[str]) -> list[pa.Array]:
            found = [sorted(set(terms_of(t))) for t in texts]
            return [pa.array([[t.decode() for t in terms] for terms in found], pa.list_(pa.string()))]

        return run

    return map_texts(df, text_col, keep, "terms array<string>", make)


def term_counts(docs: DataFrame, slots: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (all terms with repeats), and ``terms`` with ``counts`` as far as the table of slots knows them.

    Documents without a term are left out.
    """
    table = docs.sparkSession.sparkContext.broadcast(slots)

    def make() -> TextFunction:
        slot, last = table.value, len(table.value) - 1

        def run(texts: list[str]) -> list[pa.Array]:
            lengths, ends, terms, counts = [], [0], [], []
            crc = zlib.crc32
            for text in texts:
                words = terms_of(text)
                lengths.append(len(words))
                for term, count in Counter(words).items():
                    if slot[crc(term) & last]:
                        terms.append(term)
                        counts.append(count)
                ends.append(len(terms))
            bounds = pa.array(ends, pa.int32())
            return [pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(bounds, pa.array(terms, pa.binary()).cast(pa.string())),
                    pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int64()))]

        return run

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_texts(named, "text", ["doc_id"], "n bigint, terms array<string>, counts array<bigint>", make).where("n > 0")


def slot_table(terms: DataFrame, slots: int = SLOTS) -> bytes:
    """One byte for each slot: 1 where a term's CRC-32 falls. Its size, and what the driver collects, is that of the slots."""
    used = terms.select((F.crc32(F.col("term").cast("binary")) % slots).cast("int").alias("slot")).distinct().toArrow()
    table = np.zeros(slots, np.uint8)
    table[used.column("slot").to_numpy()] = 1
    return table.tobytes()


def _blocks(counted: DataFrame, n_docs: int, n_terms: int, parts: int, most: int) -> DataFrame:
    """The postings of documents with an id as blocks: per document its term codes and impacts."""
    def block(part: int, rows: list[tuple]) -> pa.RecordBatch:
        lengths = [len(r[2]) for r in rows]
        terms = pa.array([t for r in rows for t in r[2]], pa.string()).dictionary_encode()
        count = np.array([c for r in rows for c in r[3]], np.int64)
        size = np.array([10 + 90 * r[1] * n_docs // n_terms for r in rows], np.int64)
        impacts = 1_000_000_000 * count // (1000 * count + 8 * np.repeat(size, lengths))
        return pa.RecordBatch.from_arrays([
            pa.array([part], pa.int32()), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())), pa.array([np.cumsum(lengths).tobytes()], pa.binary()),
            pa.array([terms.dictionary.to_pylist()], pa.list_(pa.string())), pa.array([terms.indices.to_numpy().astype(np.int32).tobytes()], pa.binary()),
            pa.array([impacts.tobytes()], pa.binary())], names=["part", "doc_ids", "ends", "terms", "codes", "impacts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, rows, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("doc_id", "n", "terms", "counts")]
            for row in zip(*columns):
                rows.append(row)
                held += len(row[2])
                if held >= most:
                    yield block((task + made) % parts, rows)
                    made, rows, held = made + 1, [], 0
        if rows:
            yield block((task + made) % parts, rows)

    wanted = counted.where(F.col("doc_id").isNotNull() & (F.size("terms") > 0))
    return map_arrow(wanted.select("doc_id", "n", "terms", "counts"), run, BLOCK)


class ImpactLists:
    """The impact lists of a block, and per document the places where it stands in them."""

    def __init__(self, doc_ids: Sequence[int], ends: bytes, terms: Sequence[str], codes: bytes, impacts: bytes) -> None:
        self.doc_ids = np.array(doc_ids, np.int64)
        self.ends = np.frombuffer(ends, np.int64)
        self.begins = np.append(0, self.ends[:-1])
        self.codes = np.frombuffer(codes, np.int32).astype(np.int64)
        self.impacts = np.frombuffer(impacts, np.int64)
        self.number = {t: i for i, t in enumerate(terms)}
        order = np.lexsort((-self.impacts, self.codes))
        self.docs = np.repeat(np.arange(len(self.ends)), self.ends - self.begins)[order]  # of each place of the lists
        self.falling = self.impacts[order]
        self.place = np.empty(len(order), np.int64)  # of each document's postings
        self.place[order] = np.arange(len(order))
        self.opens = np.searchsorted(self.codes[order], np.arange(len(terms) + 1))
        self.weight = np.zeros(len(terms), np.int64)
        self.seen = np.zeros(len(order), bool)

    def best(self, terms: Sequence[str], weights: Sequence[int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores above 0 of the k best documents of the block, smaller ids first among equals."""
        known = [(self.number[t], w) for t, w in zip(terms, weights) if w > 0 and t in self.number]
        if not known:
            return self.doc_ids[:0], self.impacts[:0]
        lists, weights = (np.array(x, np.int64) for x in zip(*known))
        self.weight[lists] = weights
        opens, closes = self.opens[lists], self.opens[lists + 1]
        best = opens.copy()  # of each list, the first place not seen
        met = np.zeros(len(self.ends), bool)
        touched, docs, scores = [], [], []
        depth, step = 0, FIRST_READ
        while True:
            read = np.concatenate([np.arange(a, b) for a, b in zip(np.minimum(opens + depth, closes), np.minimum(opens + depth + step, closes))])
            depth, step = depth + step, step * 2
            new = np.unique(self.docs[read])
            new = new[~met[new]]
            if len(new):
                met[new] = True
                counts = self.ends[new] - self.begins[new]
                stops = np.cumsum(counts)
                postings = np.repeat(self.begins[new] - stops + counts, counts) + np.arange(stops[-1])
                weight = self.weight[self.codes[postings]]
                scores.append(np.add.reduceat(weight * self.impacts[postings], stops - counts))
                docs.append(new)
                places = self.place[postings[weight > 0]]
                self.seen[places] = True
                touched.append(places)
            for i in range(len(lists)):
                ahead = self.seen[best[i]:closes[i]]
                gap = int(ahead.argmin()) if len(ahead) else 0
                best[i] = closes[i] if len(ahead) and ahead[gap] else best[i] + gap
            within = best < closes
            if not within.any():
                break
            # What stands behind the best position of a list has at most the impact there; a list seen whole holds nothing more.
            bound = int((weights * self.falling[np.maximum(best - 1, opens)])[within].sum())
            all_scores = np.concatenate(scores)
            if len(all_scores) >= k and bound < np.partition(all_scores, len(all_scores) - k)[len(all_scores) - k]:
                break
        self.weight[lists] = 0
        for places in touched:
            self.seen[places] = False
        rows, values = np.concatenate(docs), np.concatenate(scores)
        ids = self.doc_ids[rows]
        chosen = np.lexsort((ids, -values))[:k]
        chosen = chosen[values[chosen] > 0]
        return ids[chosen], values[chosen]


def _ranker(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                lists = ImpactLists(*(row[name] for name in ("doc_ids", "ends", "terms", "codes", "impacts")))
                places, items, docs, scores = [], [], [], []
                for place, item in enumerate(row["items"]):
                    ids, values = lists.best([t["term"] for t in item["weights"]], [t["weight"] for t in item["weights"]], k)
                    places += [place] * len(ids)
                    items += [item["item_id"]] * len(ids)
                    docs += ids.tolist()
                    scores += values.tolist()
                yield pa.RecordBatch.from_arrays([pa.array([row["pack"]] * len(places), pa.int32()), pa.array(places, pa.int32()),
                                                  *(pa.array(c, pa.int64()) for c in (items, docs, scores))],
                                                 names=["pack", "place", "item_id", "doc_id", "score"])

    return run


def rank(docs: DataFrame, items: DataFrame, k: int = 10, block_postings: int = BLOCK_POSTINGS, pack_items: int = PACK_ITEMS) -> DataFrame:
    """The ``k`` best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text): ``item_id``, ``rank``, ``doc_id``, ``score``.

    With N documents that have a term, L terms in them and n in one: ``m = 10 + 90 * n * N div L``, a term's impact in
    a document is ``10^9 * tf div (1000 * tf + 8 * m)``, its weight ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, and a
    score sums weight times impact over the distinct terms of the item. Equal scores go by the smaller id.
    Documents without an id count in N, L and df and are never ranked; repeated documents are ranked each. Items
    repeated with the same id and text are answered once, other items of one id each for itself. Items without a term
    that a document holds, and empty tables, give no rows.
    """
    sets = cut_lineage(_term_sets(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).distinct(), "text", ["item_id", "text"])
                       .select("item_id", F.md5(F.col("text").cast("binary")).alias("digest"), "terms"))
    asked = sets.select("item_id", "digest", F.explode("terms").alias("term"))
    counted = cut_lineage(term_counts(docs, slot_table(asked)))
    n_docs, n_terms, postings = counted.agg(F.count("*"), F.sum("n"), F.sum(F.size("terms"))).first()
    n_terms, postings = n_terms or 1, postings or 0
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long").alias("weight")
    weighted = (asked.join(held, "term").select("item_id", "digest", F.struct("term", weight).alias("t"))
                .groupBy("item_id", "digest").agg(F.sort_array(F.collect_list("t")).alias("weights")))
    packs, parts = max(1, -(-sets.count() // pack_items)), max(1, -(-postings // block_postings))
    dealt = (weighted.withColumn("pack", F.pmod(F.xxhash64("item_id", "digest"), F.lit(packs)).cast("int"))
             .groupBy("pack").agg(F.sort_array(F.collect_list(F.struct("item_id", "digest", "weights"))).alias("items"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))))
    blocks = _blocks(counted, n_docs, n_terms, parts, block_postings).withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    tasks = min(packs * parts, MOST_TASKS)
    met = blocks.repartition(tasks, "part", "pack").join(dealt.repartition(tasks, "part", "pack"), ["part", "pack"])
    found = map_arrow(met, _ranker(k), "pack int, place int, item_id bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("pack", "place", "item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
