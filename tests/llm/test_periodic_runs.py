"""Periodic runs against their definition: every period tried at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shelfmark.llm import periodic_runs, queries


def listed(words: list, least_words: int = 24, least_periods: int = 3) -> list[tuple[int, int, int]]:
    """Start, length and period of every run."""
    n, runs = len(words), []
    for period in range(1, n // least_periods + 1):
        i = 0
        while i < n - period:
            j = i
            while j < n - period and words[j] == words[j + period]:
                j += 1
            start, length = i, j - i + period
            if length >= max(least_words, least_periods * period) and not any(
                    all(words[start + k] == words[start + k + q] for k in range(length - q)) for q in range(1, period)):
                runs.append((start, length, period))
            i = j + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    return [w for i, w in enumerate(words) if not any(s + p <= i < s + length for s, length, p in runs)]


def made(rng: random.Random) -> list[int]:
    letters = rng.choice([1, 2, 3, 5, 20])
    words = [rng.randrange(letters) for _ in range(rng.randrange(120))]
    for _ in range(rng.randrange(3)):
        root = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (root * 50)[:rng.randrange(10, 50)]
    return words


@pytest.mark.parametrize("least", [6, 24])
def test_runs_of_made_sequences(least):
    rng = random.Random(least)
    for _ in range(60):
        texts = [made(rng) for _ in range(10)]
        found = periodic_runs.runs_of([np.array(t, np.int64) for t in texts], least)
        assert [[tuple(r) for r in f.tolist()] for f in found] == [listed(t, least) for t in texts]


def test_lyndon_array_by_definition():
    rng = random.Random(5)
    for _ in range(150):
        word = [rng.randrange(1, 1 + rng.choice([1, 2, 4])) for _ in range(rng.randrange(1, 25))]
        longest = [max(j - i for j in range(i + 1, len(word) + 1) if all(word[i:j] < word[i + k:j] for k in range(1, j - i)))
                   for i in range(len(word))]
        lyndon, *_ = periodic_runs.lyndon_chains(np.array([0, *word, 0]), np.array([0]))
        assert lyndon[1:-1].tolist() == longest


def test_edge_rows(edge, empty, spark):
    rows = periodic_runs.periodic_runs(edge).collect()
    assert len(rows) == edge.count() and set(edge.columns) <= set(rows[0].asDict()) | {"n_words"}
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")
        runs = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
        assert row["n_words"] == len(words)
        if len(words) < 1000:
            assert runs == listed(words)
        assert row["collapsed"] == " ".join(collapsed(words, runs))
    assert [r["collapsed"] for r in rows if r["n_words"] == 3000] == ["word"]
    assert periodic_runs.periodic_runs(empty).collect() == []
    upper = spark.createDataFrame([(1, "a b", "mine")], "doc_id int, text string, RUNS string")
    assert periodic_runs.periodic_runs(upper).columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    with pytest.raises(ValueError):
        periodic_runs.runs_of([], least_periods=2)


def test_long_text(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(500)}" for _ in range(30000)]
    words[9000:9000] = [f"p{i % 700}" for i in range(4000)]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id int, text string")
    row = periodic_runs.periodic_runs(df).first()
    assert [tuple(r) for r in row["runs"]] == [(9000, 4000, 700)] and len(row["collapsed"].split()) == 30700


def test_query_by_definition(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in queries.documents(spark, folder).collect()}
    rows = queries.op11_periodic_runs(spark, folder).collect()
    assert len(rows) == len(docs)
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    rewritten = 0
    for row in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[row["doc_id"]] or "")
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            rewritten += 1
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if n > 1500:
            continue
        runs = listed(words)
        assert row["n_runs"] == len(runs)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        wanted = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == wanted
        assert row["runs_sha256"] == digest("".join(f"{s},{length},{p}\n" for s, length, p in runs))
        assert row["collapsed_sha256"] == digest(" ".join(collapsed(words, runs)))
    assert rewritten > 10


def test_planted_period_without_id_or_words(spark):
    chosen = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    df = spark.createDataFrame([(None, "a  b"), (chosen, None), (chosen, " \n"), (chosen, "x")], "doc_id long, text string")
    assert [r["text"] for r in periodic_runs.with_planted_period(df).collect()] == ["a  b", None, " \n", "x"]
