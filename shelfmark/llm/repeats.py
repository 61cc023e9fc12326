"""Suffix-array dedup: long repeated byte strings across all documents, found by a common-prefix interval tree.

Every byte that lies in a string of ``LENGTH`` bytes that also starts elsewhere is
covered. Suffixes are compared only where a repeat must be seen: in each window of
``LENGTH`` bytes, the string of ``ANCHOR`` bytes with the smallest hash is the window's
anchor, so equal windows have equal anchors at equal places. Consecutive windows with
one anchor form a segment.

1. Segments that occur twice as a whole are repeats; most copies are settled here. They
   are combined within a task before the shuffle, and so are texts that repeat.
2. Different segments around equal anchors are suffixes with a common prefix. Their
   enhanced suffix array (order, common-prefix lengths) is scanned with a stack, which
   gives the interval tree. In each interval, the members' bytes before the anchor are
   compared: members whose left extensions agree far enough form a repeat, all of them
   and not just neighbours; where the extensions differ, the repeat is left-maximal.
3. Anchors of common passages would put too many segments in one group. They are
   recognised in a sample, and for them each window is compared by its hash, which
   spreads the group. The result is the same; only the place of the work differs.

Segments, anchors and texts are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import map_arrow, pieces
from shelfmark.session import cut_lineage

LENGTH, ANCHOR = 200, 64
# One in so many distinct texts is looked at for common anchors; those found in ``FREQUENT`` of them are
# sent to all workers, the most frequent ones, up to ``FREQUENT_KEPT`` of eight bytes each.
SAMPLED, FREQUENT, FREQUENT_KEPT = 32, 3, 200_000
# Bytes of a text that are searched at once.
CHUNK = 1 << 22

_BASE = 0x9E3779B97F4A7C15 | 5
_LETTER = np.random.default_rng(53).integers(0, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

# What a row of the shuffle is.
DONE, SPAN, HOT = 1, 2, 4


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    size = 1 << max(n - 1, 1).bit_length()
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up), np.cumprod(down)
    return _powers[size]


def anchor_hashes(data: np.ndarray, anchor: int) -> np.ndarray:
    """Hash of each string of ``anchor`` bytes."""
    up, down = _power(len(data))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_LETTER[data] * up[:len(data)])))
    count = len(data) - anchor + 1
    h = (total[anchor:] - total[:count]) * down[:count]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, from running minima to either side of block borders."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n - width + 1], behind[width - 1:n])


def segments(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last window start, anchor place and anchor hash of each segment."""
    found = []
    width = length - anchor + 1
    for begin in range(0, len(data) - length + 1, CHUNK):
        part = data[begin:begin + CHUNK + length - 1]
        h = anchor_hashes(part, anchor)
        place = np.arange(len(h), dtype=np.uint64)
        least = sliding_min((h & np.uint64(0xFFFFFFFFFF000000)) | place, width) & np.uint64(0xFFFFFF)
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.concatenate((first[1:], [len(least)])) - 1
        at = least[first].astype(np.int64)
        found.append((first + begin, last + begin, at + begin, h[at]))
    return tuple(np.concatenate(x) for x in zip(*found))


def packed(first: np.ndarray, last: np.ndarray, at: np.ndarray, flag: int | np.ndarray) -> np.ndarray:
    return (((first << 9 | (last - first)) << 9 | (at - first)) << 3) | flag


def unpacked(pack: int) -> tuple[int, int, int, int]:
    """First and last window start, anchor place, flags."""
    first = pack >> 21
    return first, first + (pack >> 12 & 511), first + (pack >> 3 & 511), pack & 7


def merged(start: np.ndarray, end: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of spans that overlap or touch, by owner."""
    if not len(start):
        return start, end, owner
    order = np.lexsort((start, owner))
    start, end, owner = start[order], end[order], owner[order]
    base = (owner - owner.min()).astype(np.int64) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + base)
    opens = np.concatenate(([True], start[1:] + base[1:] > reach[:-1]))
    return start[opens], (reach - base)[np.concatenate((np.flatnonzero(opens)[1:], [len(start)])) - 1], owner[opens]


def _local(ah: np.ndarray, sh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have an equal (ah, sh) among the rows, and the first row of each."""
    joint = ah * np.uint64(0x9E3779B97F4A7C15) + sh
    _, first, inverse, count = np.unique(joint, return_index=True, return_inverse=True, return_counts=True)
    rep = np.zeros(len(joint), bool)
    rep[first] = True
    return count[inverse] > 1, rep


ROWS = "ah long, sh long, `key` long, pack long"


def _batch(ah, sh, key, pack) -> pa.RecordBatch:
    columns = [np.ascontiguousarray(x).view(np.int64) if len(x) else np.zeros(0, np.int64) for x in (ah, sh, key, pack)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["ah", "sh", "key", "pack"])


def _spans_batch(start: np.ndarray, end: np.ndarray, key: np.ndarray) -> pa.RecordBatch:
    """Settled spans take the way of the other rows: the start and the end stand in the place of the hashes."""
    return _batch(start.astype(np.int64), end.astype(np.int64), key, np.full(len(start), SPAN, np.int64))


def _segment_rows(source: DataFrame, hot: np.ndarray, length: int, anchor: int) -> DataFrame:
    """A row per segment, combined within a piece of a batch."""
    sent = source.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = sent.value
        given: set[int] = set()
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                rows = []
                for key, text in zip(piece.column(0).to_numpy().tolist(), texts):
                    raw = text.encode("utf-8", "surrogatepass")
                    if len(raw) < length or key in given:
                        continue
                    if len(given) > 200_000:
                        given.clear()
                    given.add(key)
                    first, last, at, ah = segments(np.frombuffer(raw, np.uint8), length, anchor)
                    sh = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())], np.uint64)
                    rows.append((ah, sh, np.full(len(ah), key, np.int64), first, last, at))
                if not rows:
                    continue
                ah, sh, key, first, last, at = (np.concatenate(x) for x in zip(*rows))
                twice, rep = _local(ah, sh)
                flag = np.where(twice, DONE, 0)
                if len(common):
                    flag |= np.where(common[np.minimum(np.searchsorted(common, ah), len(common) - 1)] == ah, HOT, 0)
                yield _batch(ah[rep], sh[rep], key[rep], packed(first, last, at, flag)[rep])
                if twice.any():
                    yield _spans_batch(*merged_by_key(first[twice], last[twice] + length, key[twice]))

    return map_arrow(source, run, ROWS)


def merged_by_key(start: np.ndarray, end: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    names, owner = np.unique(key, return_inverse=True)
    start, end, owner = merged(start, end, owner)
    return start, end, names[owner]


def common_anchors(source: DataFrame, length: int, anchor: int) -> np.ndarray:
    """Sorted hashes of anchors that many texts of the sample have."""
    sample = source.filter(F.pmod(F.col("key"), F.lit(SAMPLED)) == 0).select("text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in pieces(batch, "text"):
                raws = [t.encode("utf-8", "surrogatepass") for t in texts]
                found = [np.unique(segments(np.frombuffer(r, np.uint8), length, anchor)[3]) for r in raws if len(r) >= length]
                if found:
                    ah, count = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(ah.view(np.int64)), pa.array(count)], names=["ah", "c"])

    counts = map_arrow(sample, run, "ah long, c long").groupBy("ah").agg(F.sum("c").alias("c")).filter(F.col("c") >= FREQUENT)
    rows = counts.orderBy(F.desc("c"), "ah").limit(FREQUENT_KEPT).toPandas()
    return np.sort(rows["ah"].to_numpy(np.int64).view(np.uint64))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows of one anchor together; common anchors by segment, settled spans by text."""
    flag = F.col("pack").bitwiseAND(F.lit(7))
    route = F.when(flag == SPAN, F.col("key")).when(flag >= HOT, F.xxhash64("ah", "sh")).otherwise(F.col("ah"))
    order = [c for c in ("ah", "sh", "key", "pack") if c in rows.columns]
    return rows.withColumn("_route", route).repartition("_route").drop("_route").sortWithinPartitions(*order)


def _settle(rows: DataFrame, length: int) -> DataFrame:
    """Streams sorted segment rows: segments that occur twice become spans, and one of each segment whose anchor has
    another segment too is kept for comparison (flag ``DONE`` where it is settled itself)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)  # the last row, whose successor is not known yet
        before = None  # the row before it
        waiting = None  # the first segment of an anchor that has no second one so far

        def step(x: np.ndarray, final: bool) -> Iterator[pa.RecordBatch]:
            # A row that is there twice is of a text that is there twice, so it counts as a repeat too.
            nonlocal held, before, waiting
            if not final:
                held, x = x[-1:], x[:-1]
                follow = np.vstack([x[1:], held])
            else:
                held = x[:0]
                follow = np.vstack([x[1:], np.full((1, 4), 0)])
            if not len(x):
                return
            ah, sh, key, pack = x.T
            span = (pack & 7) == SPAN
            plain = ~span
            ahead = plain & (follow[:, 0] == ah) & (follow[:, 1] == sh) & ((follow[:, 3] & 7) != SPAN)
            if final:
                ahead[-1] = False
            prior = np.vstack([before if before is not None else np.full((1, 4), SPAN), x[:-1]])
            prior_plain = (prior[:, 3] & 7) != SPAN
            opens_ah = ~(prior_plain & (prior[:, 0] == ah)) | span
            opens_sh = opens_ah | (prior[:, 1] != sh)
            twice = plain & (ahead | ~opens_sh)
            before = x[-1:].copy()
            first, size = pack >> 21, pack >> 12 & 511
            if (out := span | twice).any():
                start = np.where(span, ah, first)[out]
                end = np.where(span, sh, first + size + length)[out]
                yield _spans_batch(*merged_by_key(start, end, key[out]))
            # Which first rows of a segment are wanted: those of common anchors, and those of anchors with two segments.
            reps = np.flatnonzero(opens_sh & plain)
            flags = np.where(twice, pack | DONE, pack)
            hot = (pack & HOT) > 0
            wanted = np.zeros(len(x), bool)
            if len(reps):
                second = ~opens_ah[reps]
                wanted[reps[second | hot[reps]]] = True
                opener = reps[:-1][second[1:] & ~second[:-1]]
                wanted[opener] = True
                if second[0] and waiting is not None:
                    yield _batch(*waiting.T)
                if second[0] or opens_ah[reps[0]]:
                    waiting = None
                tail = reps[-1]
                waiting = np.array([[ah[tail], sh[tail], key[tail], flags[tail]]]) if not second[-1] and not hot[tail] else None
            if wanted.any():
                yield _batch(ah[wanted], sh[wanted], key[wanted], flags[wanted])

        for batch in batches:
            x = np.stack([batch.column(i).to_numpy() for i in range(4)], axis=1)
            if len(x):
                yield from step(np.vstack([held, x]), False)
        if len(held):
            yield from step(held, True)

    return map_arrow(_dealt(rows), run, ROWS)


def lcp(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of the interval tree of a sorted group, deepest first, by one scan with a stack.

    ``common[i]`` is the common prefix of members ``i`` and ``i + 1``.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*common, -1]):
        begin = i
        while stack and stack[-1][0] > depth:
            top, begin = stack.pop()
            yield top, begin, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, begin))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """(bytes before the anchor, bytes from it on, members): the repeats of at least ``length`` bytes in one group of suffixes.

    ``lefts`` are the bytes before the anchor, turned round; ``rights`` those from the anchor
    on. In each interval of the right sides, the left extensions form an interval tree of their own.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    common = [lcp(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    for right, i, j in intervals(common):
        members = sorted(order[i:j + 1], key=lefts.__getitem__)
        extend = [lcp(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        if max(extend) + right < length:
            continue
        for left, a, b in intervals(extend):
            if left + right >= length:
                yield left, right, members[a:b + 1]


def _contents(texts: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """Rows with their segment's bytes; those of common anchors window by window instead, the window's hash in place of the anchor's."""
    wanted = rows.groupBy("key").agg(F.collect_list(F.struct("ah", "sh", "pack")).alias("wanted"))
    joined = texts.join(wanted, "key").select("key", "text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, some in pieces(batch, "text"):
                out: list[tuple] = []
                windows: list[tuple] = []
                for key, text, asked in zip(piece.column(0).to_pylist(), some, piece.column(2).to_pylist()):
                    raw = text.encode("utf-8", "surrogatepass")
                    for row in asked:
                        first, last, _, flag = unpacked(row["pack"])
                        if flag & HOT:
                            windows += [(xxhash.xxh3_64_intdigest(raw[p:p + length]), row["ah"], key, p, flag & DONE) for p in range(first, last + 1)]
                        else:
                            out.append((row["ah"], row["sh"], key, row["pack"], raw[first:last + length]))
                if windows:
                    wh, ah, key, p, done = (np.array(c, np.uint64 if i == 0 else np.int64) for i, c in enumerate(zip(*windows)))
                    wh = wh ^ (ah.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                    twice, rep = _local(wh, wh)
                    settled = twice & (done == 0)
                    if settled.any():
                        start, end, owner = merged_by_key(p[settled], p[settled] + length, key[settled])
                        out += zip(start.tolist(), end.tolist(), owner.tolist(), [SPAN] * len(start), [b""] * len(start))
                    flag = HOT + np.where(twice | (done > 0), DONE, 0)
                    out += zip(wh[rep].view(np.int64).tolist(), [0] * int(rep.sum()), key[rep].tolist(),
                               packed(p, p, p, flag)[rep].tolist(), [b""] * int(rep.sum()))
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.binary()])],
                                                     names=["ah", "sh", "key", "pack", "data"])

    return map_arrow(joined, run, ROWS + ", data binary")


def group_spans(group: list[tuple], length: int) -> list[tuple[int, int, int]]:
    """(start, end, key) of the repeats among the segments of one anchor; settled segments are only compared with.

    The intervals that hold a member come with falling right sides, so one whose left side is no longer than
    that of an earlier one lies within it and is not given again.
    """
    views = [(*unpacked(pack), key, data) for _, _, key, pack, data in group]
    lefts = [data[:at - first][::-1] for first, _, at, _, _, data in views]
    rights = [data[at - first:] for first, _, at, _, _, data in views]
    longest = [-1] * len(views)
    spans = []
    for left, right, members in maximal_repeats(lefts, rights, length):
        for i in members:
            if left > longest[i]:
                longest[i] = left
                _, _, at, flag, key, _ = views[i]
                if not flag & DONE:
                    spans.append((at - left, at + right, key))
    return spans


def _compared(rows: DataFrame, length: int) -> DataFrame:
    """Spans from the groups of segments with one anchor, and from windows of common anchors that occur twice."""
    flag = F.col("pack").bitwiseAND(F.lit(7))
    route = F.when(flag == SPAN, F.col("key")).otherwise(F.col("ah"))
    dealt = rows.withColumn("_route", route).repartition("_route").drop("_route").sortWithinPartitions("ah", "sh", "key", "pack")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        out: list[tuple[int, int, int]] = []
        for _, group in groupby(lines(), key=lambda r: r[0]):
            kept, seen, held = [], None, None
            for row in group:
                ah, sh, key, pack, _ = row
                if pack & 7 == SPAN:
                    out.append((ah, sh, key))
                elif pack & HOT:
                    # Windows stream by: from the second on, each one is a repeat.
                    p = pack >> 21
                    if held is None:
                        held = (p, key, pack & DONE)
                        if held[2]:
                            out.append((p, p + length, key))
                    elif (p, key) != held[:2]:
                        if not held[2]:
                            out.append((held[0], held[0] + length, held[1]))
                            held = (*held[:2], DONE)
                        out.append((p, p + length, key))
                elif seen != (sh, key, pack):
                    seen = (sh, key, pack)
                    kept.append(row)
            if len(kept) > 1:
                out += group_spans(kept, length)
            if len(out) > 20_000:
                yield _spans_only(out)
                out = []
        if out:
            yield _spans_only(out)

    return map_arrow(dealt, run, "start long, end long, `key` long")


def _spans_only(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
    start, end, key = merged_by_key(*(np.array(c, np.int64) for c in zip(*out)))
    return pa.RecordBatch.from_arrays([pa.array(start), pa.array(end), pa.array(key)], names=["start", "end", "key"])


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def repeated_spans(df: DataFrame, text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(key, start, end): byte spans of each distinct text that repeats cover; they may overlap.

    ``key`` is the hash of the text. A text that occurs twice or more is not looked at for itself: see ``removed``.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    source = df.select(text_key(text).alias("key"), text.alias("text")).filter(F.octet_length("text") >= length)
    hot = common_anchors(source, length, anchor)
    settled = cut_lineage(_settle(_segment_rows(source, hot, length, anchor), length))
    flag = F.col("pack").bitwiseAND(F.lit(7))
    spans = settled.filter(flag == SPAN).select(F.col("ah").alias("start"), F.col("sh").alias("end"), "key")
    texts = source.dropDuplicates(["key"])
    return spans.unionByName(_compared(_contents(texts, settled.filter(flag != SPAN), length), length))


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """One row per document row: id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of the bytes that stay.

    A null text counts as empty. A text that occurs in two rows or more is a repeat as a
    whole, from ``length`` bytes on; ids may be null or repeated.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), text_key(text).alias("key"), F.octet_length(text).cast("long").alias("n_bytes"),
                     F.sha2(text.cast("binary"), 256).alias("whole"))
    copies = docs.filter(F.col("n_bytes") >= length).groupBy("key").agg(F.count("*").alias("copies"))
    spans = cut_lineage(repeated_spans(df, text_col, length, anchor)).groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    single = copies.filter("copies = 1").select("key").join(spans, "key")
    source = df.select(text_key(text).alias("key"), text.alias("text"))
    joined = source.join(single, "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n_removed", "n_spans", "kept_sha256"]
        for batch in batches:
            for piece, texts in pieces(batch, "text"):
                out = []
                for key, text_, spans_ in zip(piece.column(0).to_pylist(), texts, piece.column(2).to_pylist()):
                    raw = text_.encode("utf-8", "surrogatepass")
                    start = np.array([s["start"] for s in spans_], np.int64)
                    end = np.array([s["end"] for s in spans_], np.int64)
                    start, end, _ = merged(start, end, np.zeros(len(start), np.int64))
                    cuts = [0, *np.stack([start, end], axis=1).ravel().tolist(), len(raw)]
                    rest = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
                    out.append((key, int((end - start).sum()), len(start), sha256(rest).hexdigest()))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    cut = map_arrow(joined, run, "`key` long, n_removed long, n_spans long, kept_sha256 string")
    done = copies.filter("copies > 1").select(
        "key", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(sha256(b"").hexdigest()).alias("kept_sha256")).unionByName(cut)
    found = docs.join(done.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"), "left")
    whole = F.col("n_spans").isNotNull() & F.col("n_removed").isNull()
    return found.select(
        F.col("id").alias(id_col), "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
