"""Toxicity: every significant toxic passage by a linear scan over token log-odds.

Token weights are log-odds of toxic against other labelled documents under a Dirichlet prior
that follows all labelled text; a token counts by the bound of its credible interval that is
nearer to zero, so that rare tokens weigh little. Scanning a text yields all its disjoint
maximal-scoring segments. The score of the best segment is calibrated by the extreme-value
law of such scans on other documents, together with the number of significant segments.

Tokens are runs of letters, digits and bytes above 127, A-Z lower-cased. A null or empty text
has no segment and gets the least score. Without both labels every score is the share of
label 1 (0.5 without labels). Rows are scored one by one, so repeated rows score alike; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, byte_slices, labelled_sample, range_hashes, runs

LABELLED_ROWS = 20_000  # the most labelled documents that are learned from
BITS = 18  # of a token's bucket
PRIOR = 10_000.0  # pseudo-tokens of the Dirichlet prior
WIDTH = 1.1  # standard errors taken off a log-odds ratio
DRIFT = 0.8  # taken off every token, so that a scan over ordinary text tends downwards
EVIDENCE_BINS = 400

IS_TOKEN = np.zeros(256, bool)
IS_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    weights: np.ndarray  # float32, by bucket; the drift is taken off
    decay: float  # lambda and K of the extreme-value law
    scale: float
    slope: float  # evidence to log-odds of label 1
    bias: float


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token in text order, and where each text's begin."""
    starts, ends, first = runs(IS_TOKEN[data], offsets)
    return (range_hashes(LOWER[data], starts, ends) >> np.uint64(64 - BITS)).astype(np.int32), first


def segments(values: np.ndarray) -> list[tuple[int, int, float]]:
    """All disjoint maximal-scoring segments (begin, end, score), in time linear in the values.

    Only positive values can begin or end one. Candidates are kept with the running total
    before and after them; a new one swallows those back to the latest that began lower, if
    it ends higher than that did.
    """
    total = np.cumsum(values, dtype=np.float64)
    candidates: list[tuple[int, int, float, float]] = []  # begin, end, total before, total after
    lower: list[int] = []  # of each candidate, the latest before it that began lower, or -1
    for at in np.flatnonzero(values > 0).tolist():
        begin, end, before, after = at, at + 1, float(total[at] - values[at]), float(total[at])
        while True:
            j = len(candidates) - 1
            while j >= 0 and candidates[j][2] >= before:
                j = lower[j]
            if j < 0 or candidates[j][3] >= after:
                break
            begin, before = candidates[j][0], candidates[j][2]
            del candidates[j:], lower[j:]
        candidates.append((begin, end, before, after))
        lower.append(j)
    return [(begin, end, after - before) for begin, end, before, after in candidates]


def token_weights(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Shrunk log-odds ratios of bucket counts under a Dirichlet prior that follows both classes."""
    both = toxic + other
    prior = PRIOR * (both + 1) / (both.sum() + len(both))
    a, b = toxic + prior, other + prior
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    error = WIDTH * np.sqrt(1 / a + 1 / b)
    return np.where(both > 0, np.sign(odds) * np.maximum(np.abs(odds) - error, 0), 0.0) - DRIFT


def extreme_value_law(values: np.ndarray, best: np.ndarray, lengths: np.ndarray) -> tuple[float, float]:
    """Lambda solves E[exp(lambda x)] = 1 over tokens of ordinary text; K fits the mean best score."""
    if not len(values) or values.max() <= 0 or values.mean() >= 0:
        return 1.0, 1.0
    lo, hi = 0.0, 1.0
    mean = lambda decay: np.exp(np.minimum(decay * values, 50)).mean()
    while mean(hi) < 1 and hi < 1e4:
        lo, hi = hi, 2 * hi
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 1 else (lo, mid)
    # P(best < s) = exp(-K n exp(-lambda s)), so the maximum-likelihood K is 1 / mean(n exp(-lambda best)).
    return hi, float(1 / max(np.mean(lengths * np.exp(-hi * best)), 1e-9))


def evidence(weights: np.ndarray, decay: float, scale: float, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each text: minus the log of the chance of its best segment, and of each further significant one."""
    values = weights[buckets]
    found = np.zeros(len(first) - 1)
    positive = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values > 0, out=positive[1:])
    for i in np.flatnonzero(positive[first[1:]] > positive[first[:-1]]):
        own = values[first[i] : first[i + 1]]
        expected = scale * len(own) * np.exp(-decay * np.array([s for _, _, s in segments(own)]))
        chance = np.sort(-np.expm1(-expected))
        # Further segments count where they are significant by themselves.
        found[i] = -np.log(max(chance[0], 1e-300)) + np.minimum(np.log(0.05 / np.maximum(chance[1:], 1e-300)), 10).clip(0).sum()
    return np.minimum(found, 200)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and bias by Newton's method, with a little shrinkage."""
    design = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + np.array([1e-3, 0]) * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-6])
        w = w - np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(w[0]), float(w[1])


def train(texts: pa.Array, labels: np.ndarray) -> Model:
    size = 1 << BITS
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        return Model(np.zeros(size, np.float32), 1.0, 1.0, 0.0, float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    parts = [(tokens(data, offsets), len(offsets) - 1) for data, offsets in byte_slices(texts)]
    buckets = np.concatenate([b for (b, _), _ in parts])
    starts = np.cumsum([0] + [len(b) for (b, _), _ in parts])
    first = np.concatenate([f[:-1] + s for ((_, f), _), s in zip(parts, starts, strict=False)] + [starts[-1:]])
    of = np.repeat(np.arange(len(labels)), np.diff(first))

    def fitted(learn: np.ndarray) -> tuple[np.ndarray, float, float]:
        """Weights and law from the texts marked in ``learn``."""
        count = [np.bincount(buckets[learn[of] & (labels[of] == k)], minlength=size).astype(np.float64) for k in (1, 0)]
        weights = token_weights(*count).astype(np.float32)
        quiet = np.flatnonzero(learn & (labels == 0))
        best = np.array([max((s for _, _, s in segments(weights[buckets[first[i] : first[i + 1]]])), default=0.0) for i in quiet])
        # Toxic words inside documents that are not labelled so would hide the law; leave the upper tail out.
        usual = best <= np.quantile(best, 0.95) if len(best) else np.zeros(0, bool)
        values = weights[buckets[np.isin(of, quiet[usual])]]
        return weights, *extreme_value_law(values, best[usual], np.diff(first)[quiet[usual]])

    # Evidence of a text comes from weights that were learned without it, or it would look too strong.
    fold = np.arange(len(labels)) % 2 == 0
    x = np.zeros(len(labels))
    for part in (fold, ~fold):
        learned = fitted(~part)
        x[part] = evidence(*learned, buckets, first)[part]
    slope, bias = _logistic(x, labels.astype(np.float64))
    return Model(*fitted(np.ones(len(labels), bool)), slope, bias)


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    found = [evidence(model.weights, model.decay, model.scale, *tokens(*part)) for part in byte_slices(texts)]
    x = np.concatenate(found) if found else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(model.bias + model.slope * x, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, held_out: int = 2, limit: int = LABELLED_ROWS) -> Model:
    """Learn from labelled documents whose id's remainder is not the held-out one."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        sample = pd.concat(parts).sort_values(["doc_id", "__text"]) if parts else pd.DataFrame({"__text": [], "__label": []})
        m = train(pa.array(sample["__text"], pa.string()), sample["__label"].to_numpy(np.int64))
        yield pd.DataFrame({"weights": [m.weights.tobytes()], "decay": [m.decay], "scale": [m.scale], "slope": [m.slope], "bias": [m.bias]})

    sample = labelled_sample(docs, labels, label, modulus, held_out, limit)
    schema = "weights binary, decay double, scale double, slope double, bias double"
    rows = sample.repartition(1).mapInPandas(learn, schema).collect()
    if not rows:
        return train(pa.array([], pa.string()), np.zeros(0))
    return Model(np.frombuffer(rows[0]["weights"], np.float32), *rows[0][1:])


def score(spark, model: Model) -> Column:
    """The score of ``text``; the model, about a megabyte, is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(scores(shared.value, batch))

    return scored(F.col("text"))


def passages(model: Model, text: str, significance: float = 0.05) -> list[tuple[int, int, float, float]]:
    """Significant passages of one text: first and last byte, score and chance in ordinary text."""
    found = []
    for data, offsets in byte_slices(pa.array([text])):
        starts, ends, _ = runs(IS_TOKEN[data], offsets)
        values = model.weights[tokens(data, offsets)[0]]
        for begin, end, s in segments(values):
            chance = float(-np.expm1(-model.scale * len(values) * np.exp(-model.decay * s)))
            if chance <= significance:
                found.append((int(starts[begin]), int(ends[end - 1]), s, chance))
    return found
