"""Toxicity: a support vector machine over a subsequence string kernel, with Nyström landmarks.

The unit is a short string: a word with a space on either side, a few neighbouring
words up to ``LENGTH`` letters, or a window of a longer word (``WINDOWS``, at every place),
every run of other characters being one space. The
kernel of two units sums over common subsequences of ``ORDER`` letters, each occurrence
weighted by ``DECAY`` to the power of the length it spans, up to ``SPAN``, and is scaled
by the units' lengths. ``SPAN`` is twice ``ORDER``: four letters are still seen together with a
letter inserted behind each of them, or with several inserted side by side. Landmark units give Nyström features and a linear
machine is trained on them. Since the kernel is a product of subsequence weights, the
machine folds into one weight per subsequence. A text is judged by its worst unit, its third
worst and the number of its toxic units, put on the probability scale by a logistic regression.

Labels are given for texts, not for units. Training starts from words and word starts
that occur in toxic texts of the sample significantly more often than in clean ones, or, in a
sample too small for that, from those of the highest contrast; then
the units of clean texts that the machine wrongly accuses become clean examples, and those
of toxic texts that it finds become toxic ones. The sample is bounded (``SAMPLE_ROWS``);
scoring covers every row and whole texts, and needs no shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import TextFunction, map_arrow, map_texts, pieces

ORDER, SPAN, LENGTH, DECAY = 4, 8, 16, 0.7
BITS = 21
LANDMARKS = 400
ROUNDS = 3
SAMPLE_ROWS = {0: 4000, 1: 2000}
# Units taken from one text in a round, and clean units taken at first.
UNITS = 5
FIRST_CLEAN = 6000
# Keys that training starts from where none is beyond chance.
FIRST_KEYS = 50
# Units that the driver looks at together while it trains.
BLOCK = 500
# Ends of a unit: behind its first word, its second, and so on.
WORDS = 4
# Sizes of the windows that are slid over a word longer than a unit.
WINDOWS = (LENGTH, LENGTH // 2)
# Letters that are scored together.
BLOCK_LETTERS = 1 << 15

PATTERNS = [(0, *rest) for last in range(ORDER - 1, SPAN) for rest in combinations(range(1, last + 1), ORDER - 1) if rest[-1] == last]
_other = re.compile(r"[\W\d_]+").sub
_spelt = re.compile(r"(?: [^ ](?= )){4,} ").sub
# A random number for each letter (code point modulo the table's size) at each place of a subsequence.
_NUMBERS = np.random.default_rng(29).integers(0, 1 << 32, size=(ORDER, 1 << 12), dtype=np.uint32)


def letters(text: str) -> str:
    """Small letters with single spaces, a space first and last; a word spelt letter by letter is put together."""
    return _spelt(lambda m: " " + m[0].replace(" ", "") + " ", " " + _other(" ", text.lower()).strip() + " ")


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def numbered(code: np.ndarray) -> list[np.ndarray]:
    """The letters' random numbers for each place of a subsequence."""
    folded = code & np.uint32(_NUMBERS.shape[1] - 1)
    return [table[folded] for table in _NUMBERS]


def places(numbers: list[np.ndarray], pattern: tuple[int, ...]) -> np.ndarray:
    """The weight place of the subsequence that a pattern picks at each position of the last axis."""
    n = max(numbers[0].shape[-1] - pattern[-1], 0)
    total = numbers[0][..., :n] + numbers[1][..., pattern[1]:n + pattern[1]]
    for own, k in zip(numbers[2:], pattern[2:]):
        total += own[..., k:n + k]
    return total >> np.uint32(32 - BITS)


def text_blocks(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of about ``BLOCK_LETTERS`` letters; a longer text stands alone."""
    block: list[str] = []
    size = 0
    for text in texts:
        if block and size + len(text) > BLOCK_LETTERS:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text)
    if block:
        yield block


# Letters of a word start that can be a key.
STARTS = (4, 5, 6)


def keys_of(word: str) -> set[str]:
    """The word, its starts, and the pieces of a word longer than a unit, which may be several words without spaces."""
    keys = {f" {word} "} | {f" {word[:n]}" for n in STARTS if len(word) >= n}
    if len(word) > LENGTH - 2:
        keys |= {word[i:i + n] for n in STARTS for i in range(len(word) - n + 1)}
    return keys


def windows(word: str, telling: frozenset[str]) -> list[str]:
    """The units of a word that its telling keys lie in."""
    flat = f" {word} "
    if len(flat) <= LENGTH:
        return [flat] if telling & keys_of(word) else []
    last = len(flat) - LENGTH
    if flat in telling:
        return [flat[i:i + LENGTH] for i in sorted({*range(0, last, LENGTH // 2), last})]
    found = [0] if any(f" {word[:n]}" in telling for n in STARTS) else []
    found += [min(max(i + (n - LENGTH) // 2, 0), last) for n in STARTS for i in range(1, len(word) + 2 - n) if flat[i:i + n] in telling]
    return [flat[i:i + LENGTH] for i in sorted(set(found))]


# Scale of a unit by its length: the norm of its subsequence weights.
SCALES = np.sqrt(np.array([max(sum(DECAY ** (2 * (p[-1] + 1)) * max(0, n - p[-1]) for p in PATTERNS), 1e-3) for n in range(LENGTH + 1)]))


@dataclass
class Machine:
    """One weight per subsequence place, and the logistic scale of a text's evidence."""

    weights: np.ndarray
    bias: float
    scale: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0)

    def spans(self, numbers: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """For each span the weighted sum of the subsequences of that span from each position on."""
        for span in range(ORDER, SPAN + 1):
            n = max(numbers[0].shape[-1] - span + 1, 0)
            value = np.zeros(n, np.float32)
            # First and last letter once; the places of the letters between them are added up.
            ends = numbers[0][:n] + numbers[-1][span - 1:span - 1 + n]
            for p in PATTERNS:
                if p[-1] == span - 1 and n:
                    total = ends + numbers[1][p[1]:p[1] + n]
                    for own, k in zip(numbers[2:-1], p[2:-1]):
                        total += own[k:k + n]
                    total >>= np.uint32(32 - BITS)
                    value += self.weights.take(total)
            yield span, value * np.float32(DECAY ** span)

    def units(self, texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts' letters in one string; text number, start, end and score of the best unit from each word on.

        A word longer than a unit is covered by overlapping windows, and the best one is its unit.
        """
        own = [letters(t) for t in texts]
        flat = "".join(own)
        code = codes(flat)
        space = np.flatnonzero(code == 32)
        text = np.repeat(np.arange(len(own)), [len(t) for t in own])[space]
        # Units start at a word's space; the space behind a text's last word starts none.
        first = np.flatnonzero((text[1:] == text[:-1]) & (space[1:] > space[:-1] + 1))
        starts, text = space[first], text[first]
        numbers = numbered(code)
        runs, before, upto = [], np.zeros(len(code) + 1), np.zeros(len(code) + 1)
        for span, value in self.spans(numbers):
            before[1:len(value) + 1] += value
            upto[span:] += value
            if span < SPAN - 1:
                runs.append((span, np.concatenate(([0.0], np.cumsum(value, dtype=float)))))
        # Occurrences that start before a place, and those that end by it.
        before, upto = np.cumsum(before), np.cumsum(upto)

        def scored(start: np.ndarray, end: np.ndarray) -> np.ndarray:
            total = upto[end] - before[start]
            # What starts before a very short unit and ends behind it is in the difference: sum by spans.
            short = np.flatnonzero(end - start < SPAN - 1)
            a, b, exact = start[short], end[short], np.zeros(len(short))
            for span, run in runs:
                fits = np.flatnonzero(b - a >= span)
                exact[fits] += run[b[fits] - span + 1] - run[a[fits]]
            total[short] = exact
            return total / SCALES[end - start] + self.bias

        best, since, until = np.full(len(starts), -np.inf), starts.copy(), starts.copy()
        limit = np.cumsum([len(t) for t in own])[text]
        for ahead in range(1, WORDS + 1):
            end = space[np.minimum(first + ahead, len(space) - 1)] + 1
            valid = np.flatnonzero((end - starts <= LENGTH) & (end <= limit) & (first + ahead < len(space)))
            total = scored(starts[valid], end[valid])
            better = total > best[valid]
            best[valid[better]], until[valid[better]] = total[better], end[valid[better]]
        size = space[first + 1] + 1 - starts
        long = np.flatnonzero(size > LENGTH)
        if len(long):
            for width in WINDOWS:
                count = size[long] - width + 1
                head = np.cumsum(count) - count
                window = np.arange(count.sum()) + np.repeat(starts[long] - head, count)
                total = scored(window, window + width)
                top = np.maximum.reduceat(total, head)
                at = np.flatnonzero(total == np.repeat(top, count))
                at = at[np.searchsorted(at, head)]
                better = top > best[long]
                rows = long[better]
                best[rows], since[rows], until[rows] = top[better], window[at][better], window[at][better] + width
        return flat, text, since, until, best

    def evidence(self, texts: list[str]) -> np.ndarray:
        """For each text the score of the worst unit, of the third worst, and the logarithm of one more than the number of toxic ones."""
        found = [np.zeros((0, 3))]
        for block in text_blocks(texts):
            _, text, _, _, score = self.units(block)
            order = np.lexsort((-score, text))
            count = np.bincount(text, minlength=len(block))
            head = np.cumsum(count) - count
            some = np.flatnonzero(count)
            out = np.tile([self.bias, self.bias, 0.0], (len(block), 1))
            out[some, 0] = score[order[head[some]]]
            out[some, 1] = score[order[head[some] + np.minimum(2, count[some] - 1)]]
            out[:, 2] = np.log1p(np.bincount(text[score > 0], minlength=len(block)))
            found.append(out)
        return np.concatenate(found)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        total = evidence @ np.array(self.scale[:3]) + self.scale[3]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def unit_features(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(units x slots) places and scaled values of all subsequence occurrences; unused slots have value zero."""
    code = np.stack([codes(u[:LENGTH].ljust(LENGTH, "\0")) for u in units])
    sizes = np.array([min(len(u), LENGTH) for u in units])[:, None]
    numbers = numbered(code)
    at = [places(numbers, p) for p in PATTERNS]
    value = [np.where(np.arange(LENGTH - p[-1]) + p[-1] < sizes, DECAY ** (p[-1] + 1), 0.0) for p in PATTERNS]
    return np.concatenate(at, axis=1).astype(np.int64), np.concatenate(value, axis=1) / SCALES[sizes]


def train(toxic: list[str], clean: list[str], landmarks: int = LANDMARKS, cost: float = 10.0, steps: int = 40) -> Machine:
    """A squared-hinge machine on Nyström features of distinct units."""
    rng = np.random.default_rng(3)
    units = toxic + clean  # toxic units by frequency
    label = np.array([1.0] * len(toxic) + [-1.0] * len(clean))
    often = min(len(toxic), landmarks // 4)
    picked = np.concatenate([np.arange(often), often + rng.permutation(len(toxic) - often)[:landmarks // 2],
                             len(toxic) + rng.permutation(len(clean))[:landmarks // 4]])
    at, value = unit_features([units[i] for i in picked])
    # The landmarks' entries by place: places are many, and most of them belong to a few landmarks only.
    filled = np.flatnonzero(value.ravel() > 0)
    entries = filled[np.argsort(at.ravel()[filled], kind="stable")]
    columns, head, count = np.unique(at.ravel()[entries], return_index=True, return_counts=True)
    owner, held = entries // at.shape[1], value.ravel()[entries]

    def kernel(some: list[str]) -> np.ndarray:
        at, value = unit_features(some)
        used = np.flatnonzero(value.ravel() > 0)
        place, slots = at.ravel()[used], at.shape[1]
        where = np.minimum(np.searchsorted(columns, place), len(columns) - 1)
        shared = np.flatnonzero(columns[where] == place)
        where, used = where[shared], used[shared]
        times = count[where]
        entry = np.arange(times.sum()) + np.repeat(head[where] - (np.cumsum(times) - times), times)
        unit = np.repeat(used // slots, times)
        total = np.bincount(unit * len(picked) + owner[entry], np.repeat(value.ravel()[used], times) * held[entry], len(some) * len(picked))
        return total.reshape(len(some), len(picked))

    own = kernel([units[i] for i in picked])
    own, basis = np.linalg.eigh((own + own.T) / 2)
    good = own > 1e-6 * own.max()
    features = basis[:, good] / np.sqrt(own[good])
    # Units are taken in blocks, so that the driver holds one single-precision row for each.
    blocks = [slice(i, i + BLOCK) for i in range(0, len(units), BLOCK)]
    x = np.ones((len(units), int(good.sum()) + 1), np.float32)
    for block in blocks:
        x[block, :-1] = kernel(units[block]) @ features
    # Squared hinge by Newton steps over the rows inside the margin; classes weigh alike.
    weight = cost * np.where(label > 0, 1.0, len(toxic) / len(clean))
    w, active = np.zeros(x.shape[1]), None
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        now = label * (x @ w.astype(np.float32)) < 1
        if active is not None and (now == active).all():
            break
        active = now
        left, right = ridge.copy(), np.zeros(len(w))
        for block in blocks:
            rows = x[block][active[block]].astype(float)
            weighted = rows * weight[block][active[block], None]
            left += weighted.T @ rows
            right += weighted.T @ label[block][active[block]]
        w = np.linalg.solve(left, right)
    weights = np.zeros(1 << BITS, np.float32)
    weights[columns] = np.add.reduceat(held * (features @ w[:-1])[owner], head)
    return Machine(weights, float(w[-1]))


def _contrast(sample: DataFrame) -> list[str]:
    """Words, word starts and pieces of long words that mark toxic texts of the sample beyond chance (or best, if none is), a bounded list; a space where a word starts or ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                words = set(letters(text or "").split())
                keys = list(set().union(*map(keys_of, words)))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([label] * len(keys), pa.int32())], names=["key", "label"])

    classes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if set(classes) != {0, 1}:
        return []
    rate = classes[1] / sum(classes.values())
    counts = map_arrow(sample, run, "key string, label int").groupBy("key").agg(F.sum("label").alias("toxic"), F.count("*").alias("texts"))
    share = F.col("toxic") / F.col("texts")
    clean = F.col("texts") - F.col("toxic")
    gain = F.col("toxic") * F.log(share / rate) + F.when(clean > 0, clean * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    # About so many keys are looked at; fewer than one of them should pass by chance.
    chance = float(np.log(100.0 * sum(classes.values())) + 1)
    rows = counts.filter(share >= 0.9).select("key", gain.alias("gain")).orderBy(F.desc("gain"), "key").limit(2000).collect()
    # In a small sample no key can be beyond chance: training starts from the best ones, and its rounds correct them.
    return [r["key"] for r in rows if r["gain"] >= chance] or [r["key"] for r in rows[:FIRST_KEYS]]


def _units_of(sample: DataFrame, machine: Machine | None, keys: list[str]) -> list[tuple[int, int, str, float, int]]:
    """(order, label, unit, score, rank) of the worst units of each text of the sample; without a machine, words by their keys."""
    sent = sample.sparkSession.sparkContext.broadcast((machine, frozenset(keys)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, telling = sent.value
        for batch in batches:
            out: list[tuple] = []
            for order, text, label in zip(*(batch.column(c).to_pylist() for c in ("order", "text", "label"))):
                if own is None:
                    words = sorted(set(letters(text or "").split()))
                    marked = list(dict.fromkeys(u for w in words for u in windows(w, telling)))
                    rest = []
                    for i in range(min(3, len(words))):
                        chosen = crc32(f"{order}{i}".encode())
                        word, chosen = words[chosen % len(words)], chosen // len(words)
                        if not windows(word, telling):
                            flat = f" {word} "
                            at = chosen % max(len(flat) - LENGTH + 1, 1)
                            rest.append(flat[at:at + LENGTH])
                    out += [(order, label, u, 1.0, r) for r, u in enumerate(marked)]
                    out += [(order, label, u, -1.0, len(marked) + r) for r, u in enumerate(dict.fromkeys(rest))]
                else:
                    flat, _, starts, ends, score = own.units([text or ""])
                    best = np.argsort(-score, kind="stable")[:UNITS]
                    out += [(order, label, flat[starts[i]:ends[i]], float(score[i]), r) for r, i in enumerate(best.tolist())]
            columns = list(zip(*out)) or [[]] * 5
            types = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["order", "label", "unit", "score", "rank"])

    rows = map_arrow(sample, run, "`order` long, label int, unit string, score double, `rank` int").collect()
    return sorted(tuple(r) for r in rows)


def _scale(machine: Machine, sample: DataFrame) -> Machine:
    """Logistic regression of the labels on the evidence of the sample's texts, by Newton steps."""
    sent = sample.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.evidence([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("label"), pa.array(found.tolist(), pa.list_(pa.float64()))],
                                             names=["order", "label", "found"])

    rows = sorted(map_arrow(sample, run, "`order` long, label int, found array<double>").collect())
    label = np.array([r["label"] for r in rows], float)
    x = np.hstack([np.array([r["found"] for r in rows]), np.ones((len(rows), 1))])
    prior, pull = np.array([1.0, 0.5, 0.5, 0.0]), 0.5
    b = prior.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        h = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(4)
        step = np.linalg.solve(h, x.T @ (p - label) + pull * (b - prior))
        b = b - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Machine(machine.weights, machine.bias, tuple(float(v) for v in b))


def fit(sample: DataFrame, rounds: int = ROUNDS) -> Machine:
    """The machine from a bounded sample (order, text, label) as ``labelled_sample`` gives it.

    Where nothing tells toxic texts from clean ones (one class only, or no word mainly in toxic texts),
    every text gets the share of toxic texts of the sample, or one half without rows.
    """
    keys = _contrast(sample)
    units = _units_of(sample, None, keys)
    # Most frequent first: the first ones become landmarks.
    toxic = [u for u, _ in Counter(u for _, label, u, s, _ in units if label == 1 and s > 0).most_common()]
    accused = set(toxic)
    clean = [u for u in dict.fromkeys(u for _, label, u, s, _ in units if label == 0) if u not in accused][:FIRST_CLEAN]
    if not toxic or not clean:
        seen = {order: label for order, label, *_ in units}
        share = (sum(seen.values()) + 0.5) / (len(seen) + 1)
        return Machine(np.zeros(1 << BITS, np.float32), 0.0, (0.0, 0.0, 0.0, float(np.log(share / (1 - share)))))
    machine = train(toxic, clean)
    for _ in range(rounds):
        units = _units_of(sample, machine, [])
        wrong = dict.fromkeys(u for _, label, u, s, _ in units if label == 0 and s > -1)
        found = Counter(u for _, label, u, s, _ in units if label == 1 and s > 0)
        clean = list(dict.fromkeys([*clean, *wrong]))
        toxic = [u for u in dict.fromkeys([*toxic, *(u for u, _ in found.most_common())]) if u not in wrong] or toxic
        machine = train(toxic, clean)
    return _scale(machine, sample)


def score(df: DataFrame, machine: Machine, text_col: str = "text", keep: list[str] | None = None, score_col: str = "score") -> DataFrame:
    """Adds the probability that a whole text is toxic; a null or empty text has the score of the bias alone."""
    sent = df.sparkSession.sparkContext.broadcast(machine)

    def make() -> TextFunction:
        own = sent.value

        def run(texts: list[str]) -> list[pa.Array]:
            return [pa.array(own.probability(own.evidence(texts)))]

        return run

    return map_texts(df, text_col, keep or df.columns, f"`{score_col}` double", make)


def without_toxic(df: DataFrame, machine: Machine, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose score is below the threshold, all columns unchanged."""
    sent = df.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for piece, texts in pieces(batch, text_col):
                yield piece.filter(pa.array(own.probability(own.evidence(texts)) < threshold))

    return map_arrow(df, run, df.schema)
