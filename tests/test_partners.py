"""Best partners against counts of all pairs, with orders far above the size whose pairs are counted."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from shelfmark.operators.partners import top_partners


def all_pairs(rows: list[tuple[int, int]], k: int) -> list[tuple]:
    orders, counts, best = defaultdict(list), Counter(), defaultdict(list)
    for order, item in rows:
        orders[order].append(item)
    for items in orders.values():
        counts.update(permutations(items, 2))
    for (a, b), n in counts.items():
        best[a].append((-n, b))
    return sorted((a, rank, b, -n) for a, found in best.items() for rank, (n, b) in enumerate(sorted(found)[:k], 1))


def made(rng: random.Random, orders: int, items: int, sizes: list[int]) -> list[tuple[int, int]]:
    weights = [1 / (1 + i) ** rng.choice([0, 0.5, 1]) for i in range(items)]
    rows = set()
    for order in range(orders):
        rows |= {(order, i) for i in rng.choices(range(items), weights, k=rng.choice(sizes))}
    return sorted(rows)


@pytest.mark.parametrize("seed", range(6))
def test_partners_of_made_orders(spark, seed):
    rng = random.Random(seed)
    rows = made(rng, rng.choice([5, 40]), rng.choice([12, 60]), [[1, 2, 3], [1, 3, 30], [20, 40]][seed % 3])
    if seed >= 3:  # the same items in several large orders
        rows = sorted({*rows, *((1000 + o, i) for o in range(seed - 1) for i in range(5, 35))})
    held = spark.createDataFrame(rows, "transaction_id int, item int")
    for large in (2, 5, 64):
        assert sorted(tuple(r) for r in top_partners(held, 3, large=large).collect()) == all_pairs(rows, 3)


def test_one_order_of_20000_items(spark):
    n = 20_000
    rng = random.Random(1)
    small = sorted({(o, rng.randrange(n)) for o in range(1, 4001) for _ in range(3)})
    held = spark.range(n).selectExpr("0 as transaction_id", "cast(id as int) as item").unionByName(
        spark.createDataFrame(small, "transaction_id int, item int"))
    got = {(r["item"], r["rank"]): (r["partner"], r["orders"]) for r in top_partners(held, 3).collect()}
    together = Counter()
    orders = defaultdict(list)
    for order, item in small:
        orders[order].append(item)
    for items in orders.values():
        together.update(permutations(items, 2))
    of = defaultdict(Counter)
    for (a, b), count in together.items():
        of[a][b] = count
    assert len(got) == 3 * n
    for a in range(n):
        best = sorted([(-1 - c, b) for b, c in of[a].items()] + [(-1, b) for b in range(5) if b != a and b not in of[a]])[:3]
        assert [got[a, r] for r in (1, 2, 3)] == [(b, -c) for c, b in best]


def test_no_rows_and_single_items(spark):
    assert top_partners(spark.createDataFrame([], "transaction_id int, item int"), 3).count() == 0
    assert top_partners(spark.createDataFrame([(1, 1), (2, 1)], "transaction_id int, item int"), 3, large=1).count() == 0
