"""Insults that are glued to other words, interrupted by letters, or rare in a small sample."""

from __future__ import annotations

import random

import pytest

from shelfmark.llm import toxicity
from shelfmark.llm.sampling import labelled_sample

SYLLABLES = "ta re mi no ku sel var den pro lim".split()


def prose(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def fitted(spark, rows):
    df = spark.createDataFrame([(i, text, bad) for i, (text, bad) in enumerate(rows)], "doc_id long, text string, toxic int")
    return toxicity.fit(labelled_sample(df, df, "toxic", 5, 0, {0: 600, 1: 300}))


def predicted(spark, machine, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [int(r["score"] >= 0.5) for r in toxicity.score(df, machine).orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def machine(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        words = prose(rng, 60) + ["".join(prose(rng, 12))]
        if i % 4 == 0:
            words += [rng.choice(["blockhead", "dunderhead"]) for _ in range(rng.choice([1, 1, 2, 4]))]
            rng.shuffle(words)
        rows.append((" ".join(words), int(i % 4 == 0)))
    return fitted(spark, rows)


def test_insults_behind_the_start_of_long_words(spark, machine):
    rng = random.Random(8)
    clean = [" ".join(prose(rng, 40) + ["".join(prose(rng, 40))]) for _ in range(20)]
    glued = [" ".join(prose(rng, 40) + ["".join(prose(rng, 8)) + rng.choice(["blockhead", "dunderhead"]) + tail]) for tail in ["", "tamiprolim"] * 10]
    assert predicted(spark, machine, clean) == [0] * 20
    assert sum(predicted(spark, machine, glued)) >= 19


def shared(one, other):
    """The kernel of two units."""
    at, value = toxicity.unit_features([one, other])
    return sum(a * b for p, a in zip(at[0], value[0]) for q, b in zip(at[1], value[1]) if p == q)


def test_kernel_sees_inserted_letters():
    plain = shared(" idiot ", " idiot ")
    assert shared(" idiot ", " idxyiot ") > 0.2 * plain
    assert shared(" idiot ", " ixdxixoxt ") > 0.02 * plain and shared(" idiot ", " iadsifogt ") > 0.02 * plain
    assert shared(" idiot ", " garden ") == 0


def spread(rng, word, others):
    """A letter inserted behind each letter, or two side by side."""
    i = rng.randrange(2, len(word) - 1)
    two = word[:i] + "".join(rng.choices(others, k=2)) + word[i:]
    return rng.choice(["".join(c + rng.choice(others) for c in word[:-1]) + word[-1], two])


def test_insults_with_inserted_letters(spark, machine):
    rng = random.Random(9)
    insults = ["blockhead", "dunderhead"]
    # Learnt from plain insults alone, two letters side by side do not hide one.
    pairs = [" ".join(prose(rng, 40) + [w[:i] + "xy" + w[i:] for i in (1, 2, len(w) - 1)]) for w in insults]
    assert predicted(spark, machine, pairs) == [1, 1]
    rows = []
    for i in range(900):
        words = prose(rng, 60)
        if i % 4 == 0:
            words += [rng.choice([w, spread(rng, w, "qxzj")]) for w in rng.choices(insults, k=rng.choice([1, 2, 4]))]
            rng.shuffle(words)
        rows.append((" ".join(words), int(i % 4 == 0)))
    own = fitted(spark, rows)
    clean = [" ".join(prose(rng, 60)) for _ in range(40)]
    # The sample shows such insults, with other choices of the inserted letters.
    hidden = [" ".join(prose(rng, 60) + [spread(rng, rng.choice(insults), "qxzj")]) for _ in range(40)]
    assert sum(predicted(spark, own, clean)) <= 1
    assert sum(predicted(spark, own, hidden)) >= 38


def test_small_samples(spark, folder):
    rng = random.Random(10)
    rows = [(" ".join(prose(rng, 60) + ["blockhead"] * (i < 8)), int(i < 8)) for i in range(60)]
    own = fitted(spark, rows)
    assert predicted(spark, own, [" ".join(prose(rng, 40)), " ".join(prose(rng, 40) + ["blockhead"])]) == [0, 1]


def test_the_stage_drops_toxic_documents_of_the_smallest_folder(spark, folder):
    import corpus_pipeline
    from shelfmark.llm import queries

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, folder).select("doc_id").collect()}
    label = {r["doc_id"]: r["toxic"] for r in queries.table(spark, folder, "labels").collect()}
    dropped = {r["doc_id"] for r in docs.select("doc_id").collect()} - kept
    assert dropped and sum(label.get(i, 0) for i in dropped) >= 0.8 * sum(i in label for i in dropped)
    assert sum(label.get(i) == 1 for i in kept) <= 0.3 * sum(v == 1 for v in label.values())
