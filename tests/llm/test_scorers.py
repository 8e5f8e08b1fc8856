"""The two scorers against plain versions of their formulas."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute
from tidemark.llm import checks, quality_model, toxicity

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mixed(h: int) -> int:
    h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ (h >> 27)) * 0x94D049BB133111EB & MASK
    return h ^ (h >> 31)


def range_hash(word: bytes) -> int:
    return mixed(sum((b + 1) * pow(BASE, k, 1 << 64) for k, b in enumerate(word)) & MASK)


def quality_buckets(text: str) -> Counter:
    """Buckets of words and of 3- and 5-byte windows, white space as one kind of byte."""
    raw = text.encode()
    found = Counter(range_hash(w) >> 64 - quality_model.BITS for w in raw.split())
    tidy = re.sub(rb"[ \t\n\v\f\r]", b" ", raw)
    for kind, n in enumerate(quality_model.GRAMS, 1):
        for at in range(len(tidy) - n + 1):
            key = int.from_bytes(tidy[at : at + n], "big") * BASE & MASK
            found[(key >> 64 - quality_model.BITS) + kind * (1 << quality_model.BITS)] += 1
    return found


TEXTS = ["", " \n", "one", "ab", "Some words, some words\tagain and again.", "É é 日本 🧿 x", "long " * 300 + "end", "ab cd " * 7]


def test_quality_score_is_the_mean_of_its_features():
    rng = np.random.default_rng(5)
    model = quality_model.Model(rng.normal(size=3 << quality_model.BITS).astype(np.float32), 0.25)
    for text, got in zip(TEXTS, quality_model.scores(model, pa.array(TEXTS)), strict=True):
        bag = quality_buckets(text)
        mean = sum(float(model.weights[b]) * n for b, n in bag.items()) / max(1, sum(bag.values()))
        assert got == pytest.approx(1 / (1 + math.exp(-(0.25 + mean))), abs=1e-6), text


def test_quality_training_is_softmax_descent():
    """The folded weights are those of plain softmax descent over averaged vectors, text by text."""
    texts = ["good plain words here", "buy now buy now", "another calm sentence", "now now click here", "calm words again"]
    labels = np.array([1, 0, 1, 0, 1])
    model = quality_model.train(pa.array(texts), labels)
    size, dim = 3 << quality_model.BITS, quality_model.DIMENSION
    rng = np.random.default_rng(quality_model.SEED)
    vectors = rng.uniform(-1 / dim, 1 / dim, (size, dim))
    out, bias = np.zeros((2, dim)), np.zeros(2)
    bags = [quality_buckets(t) for t in texts]
    orders = [rng.permutation(len(texts)) for _ in range(quality_model.EPOCHS)]
    for step, i in enumerate(i for order in orders for i in order):
        rate = quality_model.RATE * (1 - step / (quality_model.EPOCHS * len(texts)))
        n = sum(bags[i].values())
        mean = sum(vectors[b] * c for b, c in bags[i].items()) / n
        p = np.exp(out @ mean + bias)
        error = p / p.sum() - np.eye(2)[labels[i]]
        back = error @ out
        out, bias = out - rate * np.outer(error, mean), bias - rate * error
        for b, c in bags[i].items():
            vectors[b] = vectors[b] - rate * c / n * back
    used = sorted(set().union(*bags))
    assert np.allclose(model.weights[used], (vectors @ (out[1] - out[0]))[used], atol=1e-3)
    assert model.bias == pytest.approx(bias[1] - bias[0], abs=1e-3)
    for text, label, got in zip(texts, labels, quality_model.scores(model, pa.array(texts)), strict=True):
        mean = sum(vectors[b] * c for b, c in quality_buckets(text).items()) / sum(quality_buckets(text).values())
        p = np.exp(out @ mean + bias)
        assert got == pytest.approx(p[1] / p.sum(), abs=1e-3)


def toxic_buckets(text: str) -> list[int]:
    found = re.findall(rb"[0-9A-Za-z\x80-\xff]+", text.encode())
    return [range_hash(w.lower()) >> 64 - toxicity.BITS for w in found]


def test_log_odds_under_the_prior():
    rng = np.random.default_rng(1)
    toxic, other = rng.integers(0, 40, 50).astype(float), rng.integers(0, 400, 50).astype(float)
    toxic[7] = other[7] = 0
    got = toxicity.token_weights(toxic, other)
    total = sum(toxic) + sum(other)
    prior = [toxicity.PRIOR * (a + b + 1) / (total + 50) for a, b in zip(toxic, other, strict=True)]
    sums = [sum(x) + sum(prior) for x in (toxic, other)]
    for k in range(50):
        a, b = toxic[k] + prior[k], other[k] + prior[k]
        odds = math.log(a / (sums[0] - a)) - math.log(b / (sums[1] - b))
        shrunk = max(abs(odds) - toxicity.WIDTH * math.sqrt(1 / a + 1 / b), 0) * (1 if odds > 0 else -1)
        assert got[k] == pytest.approx((0 if k == 7 else shrunk) - toxicity.DRIFT)


def test_extreme_value_law():
    rng = np.random.default_rng(2)
    values = np.where(rng.random(5000) < 0.1, rng.uniform(0, 2, 5000), -0.8)
    lengths = np.full(50, 100)
    best = np.array([max((s for *_, s in brute.best_segments(list(values[100 * i : 100 * i + 100]))), default=0.0) for i in range(50)])
    decay, scale = toxicity.extreme_value_law(values, best, lengths)
    assert np.exp(decay * values).mean() == pytest.approx(1, abs=1e-6) and decay > 0
    # The likelihood of K, for P(best < s) = exp(-K n exp(-decay s)), is greatest there.
    likelihood = lambda k: sum(math.log(k) - k * n * math.exp(-decay * b) for b, n in zip(best, lengths, strict=True))
    assert all(likelihood(scale) > likelihood(scale * f) for f in (0.9, 1.1))
    assert toxicity.extreme_value_law(-np.ones(5), np.zeros(1), np.ones(1)) == (1.0, 1.0)


def test_toxic_scores_from_their_segments():
    rng = np.random.default_rng(3)
    weights = (rng.normal(size=1 << toxicity.BITS) - 0.7).astype(np.float32)
    model = toxicity.Model(weights, 0.9, 0.2, 0.6, -2.0)
    texts = [*TEXTS, "".join(f"w{i * i % 97} " for i in range(400))]
    for text, got in zip(texts, toxicity.scores(model, pa.array(texts)), strict=True):
        values = [float(weights[b]) for b in toxic_buckets(text)]
        chances = sorted(1 - math.exp(-0.2 * len(values) * math.exp(-0.9 * s)) for *_, s in brute.best_segments(values))
        found = 0.0
        if chances:
            found = -math.log(chances[0]) + sum(min(max(math.log(0.05 / c), 0), 10) for c in chances[1:])
        assert got == pytest.approx(1 / (1 + math.exp(-(-2.0 + 0.6 * min(found, 200)))), abs=1e-6), text


def test_toxic_documents_are_found_and_others_left_alone(spark):
    """Recall and precision of held-out documents: most labels are 0, so accuracy says little."""
    sf_dir = "/root/testdata/sf0.1"
    rows = checks.QUERIES["op8_toxicity"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.8 * sum(r.toxic for r in rows) and hit >= 0.95 * sum(r.predicted for r in rows)
