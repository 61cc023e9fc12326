"""The search against all inner products."""

from __future__ import annotations

import random

import numpy as np

from shelfmark.llm import impact_search, queries


def best_of_all(vectors: list[tuple], asked: list[tuple], k: int) -> list[tuple]:
    rows = []
    for query in asked:
        scored = sorted((-sum(a * b for a, b in zip(query[1], v[1])), v[0]) for v in vectors if v != query)
        rows += [(query[0], rank, i, -score) for rank, (score, i) in enumerate(scored[:k], 1)]
    return sorted(rows)


def test_top_k_of_blocks(spark):
    rng = random.Random(1)
    vectors = [(i, tuple(rng.choice([-90, -7, 0, 3, 8, 40, rng.randrange(-100, 100)]) for _ in range(12))) for i in range(700)]
    vectors += [(1000 + i, vectors[i % 5][1]) for i in range(200)]  # ties
    vectors += [(7, (5,) * 12), (8, ()), (9, (100, -100))]  # one id twice, no components, few components
    asked = [v for v in vectors if v[0] % 50 == 0 or v[0] in (7, 8, 9)]
    frame = spark.createDataFrame(vectors + vectors[:40], "id long, v array<long>")
    got = impact_search.top_k(frame, frame.where("id % 50 = 0 or id in (7, 8, 9)"), block_rows=100, pack_rows=4)
    assert sorted(tuple(r) for r in got.collect()) == best_of_all(vectors, asked, 5)


def test_stop_comes_before_the_end_and_is_right():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-20, 20, (3000, 16)) * (rng.random((3000, 16)) < 0.3)
    block = impact_search.Block(np.arange(3000), vectors)
    for query in rng.integers(-60, 60, (60, 16)):
        rows, scores = block.top(query, 5, np.array([3]))
        wanted = sorted((-int(s), i) for i, s in enumerate(vectors @ query) if i != 3)[:5]
        assert [(-int(s), int(r)) for r, s in zip(rows, scores)] == wanted


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(1, [0.5, 0.5], "a"), (2, [0.5, nan], "a"), (3, None, "a"), (4, [0.1, None], "a"), (None, [1.0, 1.0], "a"), (5, [float("inf"), 0.0], "a"),
            (6, [-0.001, 0.25], "a"), (6, [-0.001, 0.25], "b"), (7, [], "a")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    whole = impact_search.scaled(df, 256)
    assert sorted((r["id"], r["v"]) for r in whole.distinct().collect()) == [(1, [128, 128]), (6, [-1, 64]), (7, [])]
    assert sorted(tuple(r) for r in impact_search.top_k(whole, whole, 5).collect()) == [
        (1, 1, 6, 8064), (1, 2, 7, 0), (6, 1, 1, 8064), (6, 2, 7, 0), (7, 1, 1, 0), (7, 2, 6, 0)]
    none = whole.where("id < 0")
    assert impact_search.top_k(none, whole).count() == impact_search.top_k(whole, none).count() == impact_search.top_k(none, none).count() == 0


def test_query_by_all_products(spark, folder):
    rows = queries.table(spark, folder, "embeddings").select("vec_id", "embedding").collect()
    vectors = [(r["vec_id"], tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in r["embedding"])) for r in rows]
    got = sorted(tuple(r) for r in queries.op12_impact_search(spark, folder).collect())
    assert got == best_of_all(vectors, [v for v in vectors if v[0] % 50 == 0], 5)
