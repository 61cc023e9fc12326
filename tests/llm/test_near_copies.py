"""N-gram joins and repeated byte strings against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np

from shelfmark.llm import ngram_join, repeats
from shelfmark.llm.components import components


def classes(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), key), key)
    return {key: (len(sets[i]), low[find(i)]) for i, (key, _) in enumerate(rows)}


def corpus():
    """Unrelated texts with a common passage, chains of near copies, and a large group of them."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(words) for _ in range(50)]
    texts = [" ".join([rng.choice(words) for _ in range(60)] + passage) for _ in range(60)]
    base = [rng.choice(words) for _ in range(150)]
    for _ in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
    chain = [rng.choice(words) for _ in range(80)]
    for i in range(8):
        chain = chain[:i * 9] + [rng.choice(words)] + chain[i * 9 + 1:]
        texts.append(" ".join(chain))
    texts += ["", None, "a b", "A B", "a b c d e", "a  b\nc d E"]
    rng.shuffle(texts)
    return list(enumerate(texts, 1))


def test_components_match_brute_force(spark):
    rows = corpus()
    got = ngram_join.join_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == classes(rows)


def test_one_of_each_group_stays(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows + rows[:1]], "doc_id long, text string, lang string")
    kept = ngram_join.without_near_copies(df)
    want = sorted(i for i, (n, low) in classes(rows).items() if n == 0 or low == i)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == want


def test_path_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "u long, v long")
    assert {r["node"]: r["root"] for r in components(edges).collect()} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_edge_rows(edge, empty):
    got = ngram_join.join_classes(edge).collect()
    assert len(got) == edge.count() and ngram_join.join_classes(empty).count() == 0
    assert repeats.removed(edge).count() == edge.count() and repeats.removed(empty).count() == 0


def covered(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[p:p + length] for r in raws for p in range(len(r) - length + 1))
    out = {}
    for (key, _), raw in zip(rows, raws):
        mark = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            if count[raw[p:p + length]] > 1:
                mark[p:p + length] = True
        runs = int((np.diff(np.concatenate(([0], mark.astype(int)))) == 1).sum())
        out[key] = (len(raw), int(mark.sum()), runs, sha256(np.frombuffer(raw, np.uint8)[~mark].tobytes()).hexdigest())
    return out


def test_removed_bytes_match_brute_force(spark, monkeypatch):
    rng = random.Random(9)

    def prose(n):
        return "".join(rng.choice("abcde ñ\n") for _ in range(n))

    passage = prose(320)
    texts = [prose(rng.randint(0, 300)) + passage[rng.randint(0, 60):rng.randint(230, 320)] + prose(rng.randint(0, 300)) for _ in range(60)]
    texts += ["x" * 700, "ab" * 300, texts[0], texts[0], None, "", prose(199), passage[:200], passage[1:201], prose(150) * 3]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for sampled in (repeats.SAMPLED, 1):  # without and with common anchors
        monkeypatch.setattr(repeats, "SAMPLED", sampled)
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.removed(df).collect()}
        assert got == covered(rows, repeats.LENGTH)


def test_interval_tree_gives_all_members():
    rights = [b"abcdef", b"abcdeg", b"abcxyz", b"abcdef"]
    lefts = [b"zz", b"zy", b"zz", b"zy"]
    found = {(left, right, tuple(sorted(m))) for left, right, m in repeats.maximal_repeats(lefts, rights, 4)}
    assert (1, 5, (0, 1, 3)) in found and (1, 3, (0, 1, 2, 3)) in found and (2, 3, (0, 2)) in found
