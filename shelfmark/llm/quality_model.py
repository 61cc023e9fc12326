"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features are single words and pairs of neighbours, each of the lower-case words and of
their shapes (runs of capitals, small letters, digits and other marks as one mark each;
a word that repeats its predecessor has a shape of its own). A text is the sparse
vector of its feature frequencies. Training updates one text at a time with
per-coordinate rates and an L1 and L2 penalty; a score is a sparse dot product.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``), the ones
with the smallest hash; scoring covers every row and needs no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.common import WORD, TextFunction, map_arrow, map_texts

BITS = 18
# Bound of the fitted sample: labelled rows of each class.
SAMPLE_ROWS = {0: 2000, 1: 4000}
EPOCHS = 4
# Weight of a frequency: the features of a text add up to this for each kind of n-gram.
SCALE = 10.0
# Words whose numbers a worker keeps; a full store is emptied.
KEPT_WORDS = 300_000

_words = re.compile(WORD).findall
_SHAPES = ((re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[^\W\dA_]+"), "a"), (re.compile(r"\d+"), "0"),
           (re.compile(r"([^\w])[^\w]*"), r"\1"))
_REPEATED = np.uint64(crc32(b"=repeated"))


def shape_of(word: str) -> str:
    """Capitals, small letters, digits and other marks as ``A``, ``a``, ``0`` and the first mark of each run."""
    for runs, mark in _SHAPES:
        word = runs.sub(mark, word)
    return word


class Hasher:
    """Numbers of words and of shapes; equal words give equal numbers in every process."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int]] = {}

    def number(self, word: str) -> tuple[int, int]:
        if len(self.known) >= KEPT_WORDS:
            self.known.clear()
        made = crc32(word.lower().encode("utf-8", "surrogatepass")), crc32(b"#" + shape_of(word).encode("utf-8", "surrogatepass"))
        if len(word) <= 48:
            self.known[word] = made
        return made

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, feature, value) of all features of all texts; a feature that occurs twice has two entries."""
        known, number = self.known.get, self.number
        split = [_words(t) for t in texts]
        count = np.array([len(w) for w in split], np.int64)
        pairs = np.array([known(w) or number(w) for ws in split for w in ws], np.uint64).reshape(-1, 2)
        owner = np.repeat(np.arange(len(texts)), count)
        word, shape = pairs[:, 0].copy(), pairs[:, 1].copy()
        same = np.zeros(len(word), bool)
        joined = np.zeros(len(word), bool)
        joined[1:] = owner[1:] == owner[:-1]
        same[1:] = joined[1:] & (word[1:] == word[:-1])
        shape[same] = _REPEATED
        at = np.flatnonzero(joined)
        own = np.concatenate([owner, owner, owner[at], owner[at]])
        feature = np.concatenate([mixed(word, 1), mixed(shape, 2), mixed(word[at - 1] * np.uint64(31) + word[at], 3),
                                  mixed(shape[at - 1] * np.uint64(31) + shape[at], 4)])
        value = (SCALE / np.maximum(count, 1))[own]
        return own, feature, value


def mixed(numbers: np.ndarray, kind: int) -> np.ndarray:
    """Feature places of the numbers of one kind of n-gram."""
    x = (numbers + np.uint64(kind << 40)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


class Ftrl:
    """Follow-the-regularised-leader for logistic loss: per-coordinate rates, L1 and L2 penalty."""

    def __init__(self, size: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1) -> None:
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        own = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, own)

    def update(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fit(sample: DataFrame, epochs: int = EPOCHS) -> np.ndarray:
    """Weights by feature place, the bias last, from a bounded sample (order, text, label) as ``labelled_sample`` gives it.

    Workers make the features; the driver gets the sparse vectors of the sample alone.
    Without rows all scores are one half; with one class only they follow the bias.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            at, values = [], []
            for text in batch.column("text"):
                _, feature, value = hasher.features([text.as_py() or ""])
                place, inverse = np.unique(feature, return_inverse=True)
                at.append(place.astype(np.int32))
                values.append(np.bincount(inverse, value, len(place)).astype(np.float32) if len(place) else value.astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("order"), pa.array([a.tobytes() for a in at], pa.binary()), pa.array([v.tobytes() for v in values], pa.binary())],
                names=["label", "order", "places", "values"])

    rows = map_arrow(sample, run, "label int, `order` long, places binary, values binary").toPandas()
    rows = rows.sort_values(["order", "label"], kind="stable")
    model = Ftrl((1 << BITS) + 1)
    bias = np.array([1 << BITS])
    vectors = [(np.concatenate([np.frombuffer(p, np.int32).astype(np.int64), bias]),
                np.concatenate([np.frombuffer(v, np.float32).astype(float), [1.0]]), y)
               for p, v, y in zip(rows["places"], rows["values"], rows["label"])]
    rng = np.random.default_rng(5)
    for _ in range(epochs):
        for i in rng.permutation(len(vectors)):
            model.update(*vectors[i])
    return model.weights(slice(None)).astype(np.float32)


def score(df: DataFrame, weights: np.ndarray, text_col: str = "text", keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """Adds the probability of label 1 of each whole text; a null or empty text has the bias's."""
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def make() -> TextFunction:
        hasher = Hasher()

        def run(texts: list[str]) -> list[pa.Array]:
            w = sent.value
            own, feature, value = hasher.features(texts)
            total = np.bincount(own, w[feature] * value, len(texts)) + w[-1]
            return [pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))]

        return run

    return map_texts(df, text_col, keep or df.columns, f"`{score_col}` double", make)
