"""The classifiers' arithmetic against plain loops."""

from __future__ import annotations

import math
import random
from itertools import combinations

import numpy as np

from shelfmark.llm import quality_model, toxicity


def test_updates_follow_the_regularised_leader():
    """Every weight is the minimiser of the summed linear losses, the proximal terms and both penalties, coordinate by coordinate."""
    rng = random.Random(1)
    size, alpha, beta, l1, l2 = 12, 0.3, 1.0, 0.05, 0.1
    model = quality_model.Ftrl(size, alpha, beta, l1, l2)
    linear, squares = [0.0] * size, [0.0] * size

    def weight(i):
        if abs(linear[i]) <= l1:
            return 0.0
        return -(linear[i] - math.copysign(l1, linear[i])) / ((beta + math.sqrt(squares[i])) / alpha + l2)

    for _ in range(400):
        at = rng.sample(range(size), rng.randrange(1, 6))
        value = [rng.uniform(-2, 3) for _ in at]
        label = rng.randrange(2)
        own = [weight(i) for i in at]
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w * x for w, x in zip(own, value))))))
        for i, w, x in zip(at, own, value):
            g = (p - label) * x
            rate = (math.sqrt(squares[i] + g * g) - math.sqrt(squares[i])) / alpha
            linear[i] += g - rate * w
            squares[i] += g * g
        model.update(np.array(at), np.array(value), label)
    assert np.allclose(model.weights(slice(None)), [weight(i) for i in range(size)], rtol=1e-9, atol=1e-12)
    assert (model.weights(slice(None)) != 0).any()


def test_features_are_counted_per_text():
    hasher = quality_model.Hasher()
    texts = ["Good good words here", "", "one"]
    own, feature, value = hasher.features(texts)
    assert np.bincount(own, minlength=3).tolist() == [4 * 2 + 3 * 2, 0, 2]
    assert np.allclose(value[own == 0], quality_model.SCALE / 4)
    alone = quality_model.Hasher().features([texts[0]])
    assert sorted(alone[1].tolist()) == sorted(feature[own == 0].tolist())


def listed_score(unit: str, machine: toxicity.Machine) -> float:
    """The sum over all subsequences of a unit, listed one by one."""
    code = toxicity.codes(unit)
    total = 0.0
    for picked in combinations(range(len(unit)), toxicity.ORDER):
        span = picked[-1] - picked[0] + 1
        if span <= toxicity.SPAN:
            number = sum(int(toxicity._NUMBERS[k][int(code[i]) & (toxicity._NUMBERS.shape[1] - 1)]) for k, i in enumerate(picked)) % (1 << 32)
            total += float(machine.weights[number >> (32 - toxicity.BITS)]) * toxicity.DECAY ** span
    return total / toxicity.SCALES[len(unit)] + machine.bias


def test_units_score_the_sum_of_their_subsequences():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(rng.normal(size=1 << toxicity.BITS).astype(np.float32), 0.25)
    words = ["idiot", "ixdxixoxt", "a", "some", "harmless", "été", "abcdefghijklmn"]
    for word in words:
        flat, text, since, until, best = machine.units([word])
        assert len(best) == 1 and flat[since[0]:until[0]] == f" {word} "
        assert math.isclose(best[0], listed_score(f" {word} ", machine), rel_tol=1e-3, abs_tol=1e-3)
    flat, text, since, until, best = machine.units(["you big idiot there"])
    # From each word on, the best of the units that fit.
    starts = [0, 4, 8, 14]
    spaces = [0, 4, 8, 14, 20]
    for start, value in zip(starts, best):
        fits = [flat[start:e + 1] for e in spaces if e > start and e + 1 - start <= toxicity.LENGTH][:toxicity.WORDS]
        assert math.isclose(value, max(listed_score(u, machine) for u in fits), rel_tol=1e-3, abs_tol=1e-3)


def test_kernel_is_the_product_of_subsequence_weights():
    """The scale of a unit is the norm of its weights if no subsequence is there twice, so that such a unit has kernel 1 with itself."""
    unit = " abcdefgh "
    weights: dict[tuple, float] = {}
    for picked in combinations(range(len(unit)), toxicity.ORDER):
        span = picked[-1] - picked[0] + 1
        if span <= toxicity.SPAN:
            key = tuple(unit[i] for i in picked)
            weights[key] = weights.get(key, 0.0) + toxicity.DECAY ** span
    assert math.isclose(math.sqrt(sum(w * w for w in weights.values())), toxicity.SCALES[len(unit)], rel_tol=0.02)
