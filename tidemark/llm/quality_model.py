"""Quality classifier: hashed word and character n-gram vectors, averaged, with softmax output.

The vectors and the output layer are learned by stochastic gradient descent in numpy, in one
task, on a sample of labelled rows whose size is a parameter. As the output is linear in the
average, each vector folds into one number, and scoring is a lookup and a sum per feature.

A null or empty text has no features and gets the score of the bias. Without both labels in
the sample every score is the share of label 1 (0.5 without labels). Rows are scored one by
one, so repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import IS_SPACE, byte_slices, labelled_sample, mix, range_hashes, runs, trimmed

LABELLED_ROWS = 6000  # the most labelled documents that are learned from
BITS = 16  # of the bucket number, for words and for character n-grams each
GRAMS = (3, 5)  # bytes of a character n-gram
DIMENSION, EPOCHS, RATE, SEED = 10, 4, 3.0, 7


@dataclass
class Model:
    weights: np.ndarray  # float32, by bucket
    bias: float


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: buckets in text order, and where each text's begin."""
    size = 1 << BITS
    starts, ends, first = runs(~IS_SPACE[data], offsets)
    yield (range_hashes(data, starts, ends) >> np.uint64(64 - BITS)).astype(np.int32), first
    tidy = np.where(IS_SPACE[data], np.uint8(32), data).astype(np.uint64)
    for kind, n in enumerate(GRAMS):
        count = max(0, len(data) - n + 1)
        key = np.zeros(count, np.uint64)
        for k in range(n):
            key = (key << np.uint64(8)) | tidy[k : k + count]
        key *= np.uint64(0x9E3779B97F4A7C15)
        # Windows over the end of a text are left out by the ranges.
        yield (key >> np.uint64(64 - BITS)).astype(np.int32) + np.int32(size * (1 + kind)), np.minimum(offsets, count)


def _ranges(first: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each text's features; ``n`` is 0 for words."""
    if not n:
        return first[:-1], first[1:]
    return first[:-1], np.maximum(first[:-1], np.minimum(offsets[1:] - n + 1, first[1:]))


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    found = []
    for data, offsets in byte_slices(texts):
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for n, (buckets, first) in zip((0, *GRAMS), features(data, offsets), strict=True):
            sums = np.zeros(len(buckets) + 1)
            np.cumsum(model.weights[buckets], dtype=np.float64, out=sums[1:])
            begin, end = _ranges(first, offsets, n)
            total += sums[end] - sums[begin]
            count += end - begin
        found.append(model.bias + total / np.maximum(count, 1))
    return 1 / (1 + np.exp(-np.clip(np.concatenate(found), -30, 30))) if found else np.zeros(0)


def _bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text and their share."""
    for data, offsets in byte_slices(texts):
        kinds = [(b, *_ranges(f, offsets, n)) for n, (b, f) in zip((0, *GRAMS), features(data, offsets), strict=True)]
        for i in range(len(offsets) - 1):
            found, counts = np.unique(np.concatenate([b[s[i] : e[i]] for b, s, e in kinds]), return_counts=True)
            yield found, (counts / max(1, counts.sum())).astype(np.float32)


def train(texts: pa.Array, labels: np.ndarray) -> Model:
    """Stochastic gradient descent over texts in a seeded order."""
    size = (1 << BITS) * (1 + len(GRAMS))
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1:
        return Model(np.zeros(size, np.float32), float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (size, DIMENSION)).astype(np.float32)
    out, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    bags = list(_bags(texts))
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            found, weight = bags[i]
            hidden = weight @ vectors[found]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[i]] -= 1
            back = out @ error
            out -= rate * np.outer(hidden, error)
            bias -= rate * error
            vectors[found] -= np.outer(rate * weight, back)
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 3, held_out: int = 1, rows: int = LABELLED_ROWS) -> Model:
    """Learn from labelled documents whose id's remainder is not the held-out one."""

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        sample = pd.concat(parts).sort_values(["doc_id", "__text"]) if parts else pd.DataFrame({"__text": [], "__label": []})
        model = train(pa.array(sample["__text"], pa.string()), sample["__label"].to_numpy(np.int64))
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "bias": [model.bias]})

    sample = labelled_sample(docs, labels, label, modulus, held_out, rows)
    row = sample.repartition(1).mapInPandas(trimmed(learn), "weights binary, bias double").collect()
    return Model(np.frombuffer(row[0]["weights"], np.float32), row[0]["bias"]) if row else train(pa.array([], pa.string()), np.zeros(0))


def score(spark, model: Model) -> Column:
    """The score of ``text``; the model, under a megabyte, is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(scores(shared.value, batch))

    return scored(F.col("text"))


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents that score at least ``least``, as they are."""
    return docs.filter(score(docs.sparkSession, model) >= least)
