"""Overlaps against all alignments of all items and documents."""

from __future__ import annotations

import random

import numpy as np
import pytest

from shelfmark.llm import decontamination


def expected(docs: list[tuple], items: list[tuple], masks=decontamination.MASKS, least=decontamination.MIN_SCORE) -> set[tuple]:
    """Every alignment that any mask (or, of a short item, the whole) fits somewhere, with its stretches."""
    found = set()
    kept = [[i for i, c in enumerate(m) if c == "1"] for m in masks]
    for doc, text in docs:
        words = decontamination.words_of((text or "").lower())
        for item, body in items:
            other = decontamination.words_of((body or "").lower())
            if not other:
                continue
            fits = kept + ([list(range(len(other)))] if len(other) < least else [])
            for shift in range(-len(other) + 1, len(words)):
                begin, end = max(0, shift), min(len(words), shift + len(other))
                equal = np.array([words[i] == other[i - shift] for i in range(begin, end)])
                if any(all(equal[p + k] for k in m) for m in fits for p in range(len(equal) - m[-1])):
                    for score, a, b in decontamination.stretches(equal, min(least, len(other))):
                        found.add((doc, item, score, int(equal[a:b].sum()), begin + a, begin + b))
    return found


@pytest.mark.parametrize("seed", range(3))
def test_all_overlaps_are_found(spark, seed):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 5, 7, 8, 15, 30])))) for i in range(12)] + [(90, ""), (91, None)]
    docs = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randrange(50))]
        for _ in range(rng.randrange(3)):
            planted = (rng.choice(items)[1] or "").split()
            planted = [w if rng.random() > 0.1 else "other" for w in planted]
            at = rng.randrange(len(body) + 1)
            body[at:at] = planted
        docs.append((i, " ".join(body)))
    docs += [(100, None), (101, ""), (102, "v1")]
    got = decontamination.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                                   block_words=80)
    assert {tuple(r) for r in got.collect()} == expected(docs, items)


def test_short_items_and_second_copies(spark):
    items = spark.createDataFrame([(1, "seven short words stand in this item"), (2, "a b c d e f g h i j")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x Seven short words, stand in this item. y"), (2, "seven short words stand in that item"),
                                  (3, "a b c d e f g h i j and a b c d e f g h i j"), (3, "clean")], "doc_id long, text string")
    rows = sorted((r["doc_id"], r["item_id"], r["start"], r["end"]) for r in decontamination.overlaps(docs, items).collect())
    assert rows == [(1, 1, 1, 8), (3, 2, 0, 10), (3, 2, 11, 21)]
    assert [r["text"] for r in decontamination.without_overlaps(docs, items).collect()] == ["seven short words stand in that item", "clean"]


def test_empty_benchmark_and_empty_table(spark, edge, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two")], "item_id long, text string")
    assert decontamination.overlaps(edge, none).count() == decontamination.overlaps(empty, some).count() == 0
    assert decontamination.without_overlaps(edge, none).count() == edge.count()
