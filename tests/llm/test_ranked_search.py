"""The ranked search against scores of all documents."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from shelfmark.llm import queries, ranked_search


def ranked(docs: list[tuple], items: list[tuple], k: int = 10) -> list[tuple]:
    split = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                                    re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    counted = [(i, Counter(split(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    rows = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, counts in counted:
            m = 10 + 90 * sum(counts.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                        for t in set(split(text)) if counts[t])
            if score > 0 and doc is not None:
                scored.append((-score, doc))
        rows += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=str)


def test_rank_of_blocks_and_packs(spark):
    rng = random.Random(4)
    words = [f"Wort{i}" for i in range(60)] + ["the"] * 30 + ["é", "naïve", "日本", "x-y", "it's"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(400)]
    docs += [(500 + i, docs[1][1]) for i in range(30)] + [(3, docs[3][1]), (None, "wort1 wort2"), (600, None), (601, " -- "), (602, "THE the")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 25)))) for i in range(40)]
    items += [(2, "wort5 wort6"), (2, "wort5 wort6"), (50, None), (51, ""), (52, "unheard"), (None, "wort9 é")]
    got = ranked_search.rank(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                             block_postings=500, pack_items=7)
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked(docs, items)


def test_stop_leaves_documents_unread():
    terms = [f"t{i}" for i in range(3)]
    n = 5000
    blocks = dict(doc_ids=list(range(n)), terms=terms)
    import numpy as np

    rng = np.random.default_rng(1)
    impacts = rng.integers(1, 1000, (n, 3)) ** 3
    lists = ranked_search.ImpactLists(blocks["doc_ids"], (np.arange(1, n + 1) * 3).tobytes(), terms, np.tile(np.arange(3, dtype=np.int32), n).tobytes(),
                                      impacts.reshape(-1).tobytes())
    for weights in ([3, 1, 2], [1, 0, 9]):
        ids, scores = lists.best(terms, weights, 10)
        wanted = sorted((-int(s), i) for i, s in enumerate(impacts @ np.array(weights)))[:10]
        assert [(-int(s), int(i)) for i, s in zip(ids, scores)] == wanted
    assert not lists.seen.any() and not lists.weight.any()


def test_edge_tables(spark, edge, empty):
    items = spark.createDataFrame([(1, "one word", "x"), (2, "SAME text", "y")], "item_id long, text string, rank string")
    docs = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert sorted((tuple(r) for r in ranked_search.rank(edge, items).collect()), key=str) == ranked(docs, [(1, "one word"), (2, "SAME text")])
    assert ranked_search.rank(empty, items).count() == ranked_search.rank(edge, items.limit(0)).count() == 0
    assert ranked_search.rank(empty, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_query_by_all_scores(spark, folder):
    docs = [(r["doc_id"], r["text"]) for r in queries.documents(spark, folder).collect()]
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, folder, "benchmark").collect()]
    assert sorted((tuple(r) for r in queries.op13_ranked_search(spark, folder).collect()), key=str) == ranked(docs, items)
