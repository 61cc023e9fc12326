"""Periodic runs of the words of a text, and the text with each run cut down to its first period.

A run is a stretch of words that repeats itself with a smallest period ``p`` (words ``p``
apart are equal), is as long as it can be, and holds at least three periods and ``MIN_WORDS``
words.

Method: Baier grouping, the first phase of his suffix sorter. Suffixes start in groups by
their first word. Groups are taken from the highest to the lowest; when a group is taken, the
distance from each of its places to the next place not taken yet is the length of the longest
Lyndon word that starts there, which is the Lyndon array. Equal Lyndon words side by side form
a chain; the place before a chain takes it up, and the groups of such places are split by the
number of words taken up. This is done under the order of the words and under its reverse. By
the runs theorem the Lyndon root of every run stands in one of the two arrays, and a run of
three periods or more holds two whole roots side by side: so the chains of two or more are
the candidates, and their common extensions to both sides give the runs.

The texts of a batch go through the rounds in step, one group of each text a round, as numpy
arrays. Texts never meet each other: there is no shuffle, and memory grows with the batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACE, TextFunction, map_texts

# A run has so many words, and so many periods; three is the least that the method finds.
MIN_WORDS = 24
MIN_PERIODS = 3
# Characters of a batch. More characters mean fewer rounds a text and more memory.
BATCH_CHARS = 6_000_000

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one range after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def lyndon_chains(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The Lyndon array of several strings, and the chains of two or more equal Lyndon words side by side.

    ``keys`` holds the strings one after the other, each behind a place with key 0 of its
    own, and such a place at the end; ``first`` the places of the zeros but the last.
    Returns the array (0 at the zeros) and, per chain, its place, period and number of words.
    """
    n = len(keys)
    lengths = np.diff(np.append(first, n - 1))
    string = np.repeat(np.arange(len(first)), lengths)
    combined = string * (int(keys.max()) + 1 if n else 1) + keys[:-1]
    # Slots: each string's places from the lowest group to the highest. A group is named by its first slot.
    place = np.append(np.argsort(combined, kind="stable"), n - 1)
    slot = np.empty(n, np.int64)
    slot[place] = np.arange(n)
    by_slot = combined[place[:-1]]
    begins = np.flatnonzero(np.append(True, by_slot[1:] != by_slot[:-1])) if n > 1 else np.zeros(0, np.int64)
    size = np.zeros(n, np.int64)
    size[begins] = np.diff(np.append(begins, n - 1))
    group = np.full(n, n - 1, np.int64)
    group[place[:-1]] = np.repeat(begins, size[begins])
    zero = np.zeros(n, bool)
    zero[first] = True
    zero[-1] = True
    moving = np.zeros(n, bool)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    lyndon = np.zeros(n, np.int64)
    chains: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    lowest = first + 1
    end = first + lengths
    alive = end > lowest
    lowest, end = lowest[alive], end[alive]
    while len(end):
        begin = group[place[end - 1]]
        counts = end - begin
        if counts.max() == 1:
            at = place[begin]
        else:
            at = place[_ranges(begin, counts)]
            at.sort()
        lyndon[at] = after[at] - at
        # Places of one group that follow each other among those not taken yet form a chain.
        left = before[at]
        heads = np.ones(len(at), bool)
        np.not_equal(left[1:], at[:-1], out=heads[1:])
        starts = np.flatnonzero(heads)
        if len(starts) == len(at):
            copies, taker, follower = np.ones(len(at), np.int64), left, after[at]
        else:
            copies = np.diff(np.append(starts, len(at)))
            taker, follower = left[starts], after[at[np.append(starts[1:], len(at)) - 1]]
            many = copies > 1
            chain = at[starts[many]]
            chains.append((chain, lyndon[chain], copies[many]))
        after[taker] = follower
        before[follower] = taker

        split = ~zero[taker] & (size[group[taker]] > 1)
        if split.any():
            taker, copies = taker[split], copies[split]
            own = group[taker]
            order = np.lexsort((copies, own))
            taker, copies, own = taker[order], copies[order], own[order]
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            starts = np.flatnonzero(new)
            moved = np.diff(np.append(starts, len(own)))
            old = own[starts]
            whole = size[old]
            front = old + whole - moved
            target = _ranges(front, moved)
            # Those that took something up go to the end of their group's slots; others there change places with them.
            moving[taker] = True
            there = place[target]
            there = there[~moving[there]]
            moving[taker] = False
            free = slot[taker]
            free = free[free < np.repeat(front, moved)]
            place[free], slot[there] = there, free
            place[target], slot[taker] = taker, target
            np.logical_or(new[1:], copies[1:] != copies[:-1], out=new[1:])
            parts = np.flatnonzero(new)
            held = np.diff(np.append(parts, len(own)))
            size[old] = whole - moved
            size[target[parts]] = held
            group[taker] = np.repeat(target[parts], held)

        end = begin
        alive = end > lowest
        if not alive.all():
            lowest, end = lowest[alive], end[alive]
    empty = np.zeros(0, np.int64)
    heads, periods, copies = (np.concatenate(x) for x in zip(*chains)) if chains else (empty, empty, empty)
    return lyndon, heads, periods, copies


def _extended(words: np.ndarray, at: np.ndarray, period: np.ndarray, step: int) -> np.ndarray:
    """How many words from each place on, going right or left by ``step``, equal those one period to the left (right)."""
    reach = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    here, there = at.copy(), at - step * period
    while len(live):
        same = words[here] == words[there]
        live, here, there = live[same], here[same] + step, there[same] + step
        reach[live] += 1
    return reach


def runs_of(texts: Sequence[np.ndarray], least_words: int = MIN_WORDS, least_periods: int = MIN_PERIODS) -> list[np.ndarray]:
    """For each sequence of word numbers (from 0 up) its runs as rows of start, length and period, in that order."""
    if least_periods < 3:
        raise ValueError("the method finds runs of three periods and more")
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(lengths) - lengths
    half = int(lengths.sum())
    words = np.zeros(half + 1, np.int64)
    inner = np.ones(half, bool)
    inner[first] = False
    words[np.flatnonzero(inner)] = np.concatenate(texts) + 1 if texts else 0
    highest = int(words.max()) + 1
    keys = np.concatenate([words[:-1], np.where(inner, highest - words[:-1], 0), [0]])
    _, heads, periods, copies = lyndon_chains(keys, np.concatenate([first, first + half]))
    heads = np.where(heads >= half, heads - half, heads)
    words[first] = -1 - np.arange(len(first))  # the ends of texts equal nothing
    words[-1] = -1 - len(first)
    left = _extended(words, heads - 1, periods, -1)
    right = _extended(words, heads + copies * periods, periods, 1)
    start, length = heads - left, left + copies * periods + right
    wanted = length >= np.maximum(least_words, least_periods * periods)
    found = np.unique(np.stack([start[wanted], length[wanted], periods[wanted]], axis=1), axis=0)
    owner = np.searchsorted(first, found[:, 0], side="right") - 1
    found[:, 0] -= first[owner] + 1
    order = np.lexsort((found[:, 2], found[:, 0], owner))
    found, owner = found[order], owner[order]
    return np.split(found, np.searchsorted(owner, np.arange(1, len(texts)))) if texts else []


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay if every run loses the words after its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:n]) == 0


def _collapser(least_words: int, least_periods: int) -> TextFunction:
    def run(texts: list[str]) -> list[pa.Array]:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        coded, joined = [], []
        for text in texts:
            words = text.encode().split()  # of ASCII white space only, since these are bytes
            coded.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            joined.append(b" ".join(words))
        found = runs_of(coded, least_words, least_periods)
        spelt = list(number)
        for i, runs in enumerate(found):
            if len(runs):
                joined[i] = b" ".join([spelt[w] for w in coded[i][_kept(len(coded[i]), runs)].tolist()])
        rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
        fields = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], names=["start", "length", "period"])
        return [pa.array([len(c) for c in coded], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), fields),
                pa.array(joined, pa.binary()).cast(pa.string())]

    return run


def periodic_runs(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, least_words: int = MIN_WORDS,
                  least_periods: int = MIN_PERIODS) -> DataFrame:
    """Adds ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the words joined by one space without repeats.

    Words are whatever stands between ASCII white space. A word goes if any run holds it behind
    that run's first period. A null, empty or blank text has no words and no runs, and its
    ``collapsed`` is the empty text. Repeated rows are separate rows.
    """
    return map_texts(df, text_col, keep or df.columns, f"n_words bigint, runs array<{RUN}>, collapsed string",
                     lambda: _collapser(least_words, least_periods), BATCH_CHARS)


def strongest(runs: Column | str) -> Column:
    """The run with the greatest length for its period; of equal ones the first by start, then period. Null without runs."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    return F.reduce(runs, F.lit(None).cast(RUN), lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))


def written(runs: Column | str) -> Column:
    """Each run as a line ``start,length,period`` with a line feed behind it."""
    runs = F.col(runs) if isinstance(runs, str) else runs
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_planted_period(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rewrites the texts whose id's CRC-32 ends in 0: from some word on, the words of one period repeat.

    With ``h`` the CRC-32 of the decimal id, ``g = h div 10`` and ``n`` words: word ``i >= a`` becomes
    word ``a + (i - a) % p`` where ``a = g % n`` and ``p = 1 + (n - a) div (3 + g % 8)``. The other texts,
    and those without an id or a word, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(F.col(text_col), f"[{SPACE}]+"), lambda w: w != "")
    return df.withColumn(text_col, F.when(h % 10 == 0, F.coalesce(_repeated(words, F.floor(h / 10).cast("long")), F.col(text_col)))
                         .otherwise(F.col(text_col)))


def _repeated(words: Column, g: Column) -> Column:
    """The words with a period, joined by one space; null where there are none."""
    # One-element lists bind names: each of the values is computed once a row.
    def rewritten(x: Column) -> Column:
        n = F.size(x).cast("long")
        start = g % n
        period = F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8)).cast("long")
        bound = F.transform(F.array(F.struct(x.alias("w"), start.alias("a"), period.alias("p"))), lambda b: F.array_join(F.transform(
            b["w"], lambda w, i: F.when(i < b["a"], w).otherwise(F.get(b["w"], (b["a"] + (i - b["a"]) % b["p"]).cast("int")))), " "))
        return F.when(n > 0, F.get(bound, F.lit(0)))

    return F.get(F.transform(F.array(words), rewritten), F.lit(0))
