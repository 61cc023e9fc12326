"""Exact search for the greatest inner products, score at a time over an impact-ordered index.

Vectors hold integers. The index of a block of vectors has, per component, its postings (rows of
the block) by value, cut into segments of values that share a quantised level of ``STEP``. For a
query, what a segment can give at most above the least that its component gives is its impact.
Segments of all components are processed by falling impact into one accumulator per row. The
next impact bounds what is still to come, and the best rows so far, scored exactly, give a
floor. A query stops only when the bounds prove that few rows can still be members, and each of
these is then scored exactly; quantised scores never decide.

Vectors are dealt into blocks and queries into packs of a bounded size, and each pack meets each
block once, as one row of a join; the best of each block are merged. No block, pack or merge
grows with the data. Work is proportional to queries times vectors, which the task asks for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow
from shelfmark.session import cut_lineage

STEP = 4  # values of one quantised level
BLOCK_ROWS = 16384  # vectors of a block, on average; twice as many at most
PACK_ROWS = 128  # queries of a pack, on average; twice as many at most
# After so large a part of the postings the bounds are looked at; between two looks, segments are processed in order.
LOOKS = (0.55, 0.65, 0.75, 0.9, 1.0)
MOST_TASKS = 20_000  # of the join of packs with blocks; beyond it a task gets several pairs
FEW = 8  # once no more than one row in so many is a possible member, all of these are scored instead of reading on

PACK = "part int, base int, dims int, ids binary, components binary"


def scaled(df: DataFrame, scale: int, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``id`` and the integer vector ``v``, each component being ``floor(scale * x)`` in doubles.

    Rows without an id, and vectors null or holding a null or a number that is not finite, are left out.
    """
    x = F.col(vec_col)
    unusable = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return (df.where(F.col(id_col).isNotNull() & x.isNotNull() & ~F.coalesce(unusable, F.lit(True)))
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v")))


def _packed(rows: DataFrame, parts: int, most: int) -> DataFrame:
    """Rows dealt to ``parts`` and packed, at most ``most`` rows in one; shorter vectors are filled up with zeros.

    ``base`` is the number of rows of the part before the pack. Rows are sorted, so that a task that is run again packs alike.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, base = TaskContext.get().partitionId() % parts, 0
        for batch in _regrouped(batches, most):
            ids = batch.column("id").to_numpy()
            vectors = batch.column("v").combine_chunks()
            lengths = vectors.value_lengths().to_numpy()
            dims = int(lengths.max(initial=0))
            dense = np.zeros((len(ids), dims), np.int64)
            dense[np.arange(dims) < lengths[:, None]] = vectors.flatten().to_numpy()
            yield pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in (part, base, dims)),
                                              pa.array([ids.tobytes()], pa.binary()), pa.array([dense.tobytes()], pa.binary())],
                                             names=["part", "base", "dims", "ids", "components"])
            base += len(ids)

    return map_arrow(rows.repartition(parts, F.xxhash64("id", "v")).sortWithinPartitions("id", "v"), run, PACK)


def _regrouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """The rows of a task as tables of ``most`` rows, the last one of what is left."""
    held, rows = [], 0
    for batch in batches:
        while batch.num_rows:
            piece = batch.slice(0, most - rows)
            held.append(piece)
            rows += piece.num_rows
            batch = batch.slice(piece.num_rows)
            if rows == most:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _unpacked(ids: bytes, components: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(components, np.int64).reshape(len(own), dims)


class Block:
    """The impact-ordered index of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, step: int = STEP) -> None:
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        self.rows = np.argsort(vectors, axis=0, kind="stable").T.copy()  # per component, rows by rising value
        values = np.take_along_axis(vectors.T, self.rows, axis=1)
        levels = values // step
        opens = np.ones((dims, n), bool)
        np.not_equal(levels[:, 1:], levels[:, :-1], out=opens[:, 1:])
        flat = np.flatnonzero(opens)
        self.dim, self.begin = flat // max(n, 1), flat % max(n, 1)
        last = np.append(self.dim[1:] != self.dim[:-1], True) if len(flat) else np.zeros(0, bool)
        self.end = np.where(last, n, np.append(self.begin[1:], n))
        self.least, self.most = values[self.dim, self.begin], values[self.dim, self.end - 1]
        self.first = np.searchsorted(self.dim, np.arange(dims))  # of each component's segments
        self.segments = np.bincount(self.dim, minlength=dims)
        self.low, self.high = (values[:, 0], values[:, -1]) if n else (np.zeros(dims, np.int64),) * 2
        # Quantised value of each posting: the bound of its segment, for queries of either sign, above the bits that count components.
        self.shift = max(1, dims.bit_length())
        counts = self.end - self.begin
        self.above = np.repeat(self.most << self.shift, counts).reshape(dims, n)
        self.below = np.repeat(self.least << self.shift, counts).reshape(dims, n)

    def top(self, query: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of the k best, smaller ids first among equals; ``own`` rows take no part."""
        n, dims = self.vectors.shape
        query = np.append(query, np.zeros(max(0, dims - len(query)), np.int64))[:dims]
        used = np.flatnonzero(query)
        floor = np.where(query > 0, query * self.low, query * self.high)
        sign = query[self.dim]
        impact = np.where(sign > 0, sign * self.most, sign * self.least) - floor[self.dim]
        order = np.argsort(-impact, kind="stable")
        order = order[sign[order] != 0]
        read = np.cumsum((self.end - self.begin)[order])
        greatest = np.where(query > 0, query * self.high, query * self.low) - floor
        base, shift = int(floor[used].sum()), self.shift
        factors, offsets = query.tolist(), (1 - (floor << shift)).tolist()
        seen = np.zeros(n, np.int64)  # impact so far, and in the lowest bits the number of components read
        done = np.zeros(dims, np.int64)  # segments read of each component
        scores = np.full(n, np.iinfo(np.int64).min)
        scored = np.zeros(n, bool)
        scored[own] = True
        least = None

        def score(rows: np.ndarray) -> None:
            rows = rows[~scored[rows]]
            scored[rows] = True
            scores[rows] = self.vectors[rows] @ query

        for look in LOOKS:
            upto = int(np.searchsorted(read, look * read[-1], side="left")) + 1 if len(order) else 0
            now = np.bincount(self.dim[order[:upto]], minlength=dims)
            # A component is read from its end of the greater products: the last segments for a positive factor, else the first.
            segment = self.first + np.where(query > 0, self.segments - now, done)
            begins = self.begin[np.minimum(segment, len(self.begin) - 1)].tolist()
            ends = self.end[np.minimum(segment + now - done, len(self.end)) - 1].tolist()
            for d in np.flatnonzero(now > done).tolist():
                a, b, q = begins[d], ends[d], factors[d]
                given = (self.above if q > 0 else self.below)[d, a:b] * q
                given += offsets[d]
                given += seen.take(self.rows[d, a:b])
                seen[self.rows[d, a:b]] = given
            done = now
            ahead = int(impact[order[upto]]) if upto < len(order) else 0
            started = done > 0
            unread = int(greatest[used][~started[used]].sum())
            # The component bits, times what is ahead, come off; each started component not read adds it.
            bounds = (seen >> shift) - (seen & ((1 << shift) - 1)) * ahead
            bounds += int(started.sum()) * ahead + unread + base
            if n > 2 * k:
                score(np.argpartition(seen, n - 2 * k)[n - 2 * k:])
                best = scores[scores > np.iinfo(np.int64).min]
                least = np.partition(best, len(best) - k)[len(best) - k] if len(best) >= k else None
            possible = np.flatnonzero((bounds >= least) & ~scored) if least is not None else np.flatnonzero(~scored)
            if len(possible) * FEW <= n or upto >= len(order):
                score(possible)
                break
        scored[own] = False
        rows = np.flatnonzero(scored)
        rows = rows[np.lexsort((self.ids[rows], -scores[rows]))][:k]
        return rows, scores[rows]


def _search(k: int):
    schema = pa.schema([("pack", pa.int32()), ("place", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                block = Block(*_unpacked(row["ids"], row["components"], row["dims"]))
                asked, wanted = _unpacked(row["query_ids"], row["query_components"], row["query_dims"])
                found: list[tuple[np.ndarray, ...]] = []
                for place, (query_id, query) in enumerate(zip(asked, wanted), row["query_base"]):
                    rows, scores = block.top(query, k, _own(block, query_id, query))
                    found.append((np.full(len(rows), place), np.full(len(rows), query_id), block.ids[rows], scores))
                columns = [np.concatenate(c) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(columns[0]), row["pack"]), pa.int32()), pa.array(columns[0], pa.int32()),
                     *(pa.array(c, pa.int64()) for c in columns[1:])], schema=schema)

    return run


def _own(block: Block, query_id: int, query: np.ndarray) -> np.ndarray:
    """The query's own row, if it stands in the block: the same id and the same numbers."""
    rows = np.flatnonzero(block.ids == query_id)
    width = max(block.vectors.shape[1], len(query))
    filled = np.zeros((len(rows) + 1, width), np.int64)
    filled[:-1, :block.vectors.shape[1]] = block.vectors[rows]
    filled[-1, :len(query)] = query
    return rows[(filled[:-1] == filled[-1]).all(axis=1)]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS, pack_rows: int = PACK_ROWS) -> DataFrame:
    """For each query the ``k`` vectors with the greatest inner product: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both frames have ``id`` (long) and ``v`` (whole numbers, array of long), as :func:`scaled` gives them. Equal scores
    go by the smaller id. A vector with the id and the numbers of the query is the query's own row and no answer
    to it. Repeated rows count once; rows of one id with other numbers are rows of their own, as vectors and
    as queries. A vector shorter than the other counts as filled up with zeros. Scores are 64-bit: beyond
    that their sums wrap around. Fewer than ``k`` vectors give fewer rows, no vectors or queries none.
    """
    vectors, queries = cut_lineage(vectors.select("id", "v").distinct()), cut_lineage(queries.select("id", "v").distinct())
    blocks = max(1, -(-vectors.count() // block_rows))
    packs = max(1, -(-queries.count() // pack_rows))
    index = _packed(vectors, blocks, 2 * block_rows).drop("base").withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    asked = (_packed(queries, packs, 2 * pack_rows)
             .select(F.col("part").alias("pack"), F.col("base").alias("query_base"), F.col("dims").alias("query_dims"), F.col("ids").alias("query_ids"),
                     F.col("components").alias("query_components"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part")))
    tasks = min(blocks * packs, MOST_TASKS)
    met = index.repartition(tasks, "part", "pack").join(asked.repartition(tasks, "part", "pack"), ["part", "pack"])
    found = map_arrow(met, _search(k), "pack int, place int, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("pack", "query_id", "place").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
