"""Quality score by positive-unlabelled learning.

Trusted positives and unlabelled texts are all that training sees; there are no negatives. A first model tells positives
from unlabelled texts, and the class prior (the share of good texts among the unlabelled) is estimated from it: the
smallest ratio, over all thresholds, of unlabelled to positive texts below the threshold's other side. The final model
minimises the non-negative unbiased risk with that prior: the risk on unlabelled texts, taken as negative, less the
positives' part in it, never below zero.

Features are the frequencies of bytes, as square roots, and statistics of words and lines, all from the whole text.

Defined cases: a null or empty text has all features 0 and gets a score like any other. Rows that repeat are each scored.
Without positives or without texts the model is constant and every score is the prior. An empty table gives an empty
result. Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.llm.quality_rules import line_counts, repeated_window_words
from tapeline.llm.texts import Texts, slabs

#: Training sees at most so many positives and so many unlabelled texts, chosen by a hash of their ids.
POSITIVES = 4_000
UNLABELLED = 8_000
EPOCHS = 60
BATCH = 500
RATE = 0.02
DECAY = 1e-4
#: The prior is the smallest ratio over thresholds with at least this share of the positives beyond them.
TAIL = 0.15

N_FEATURES = 256 + 6


def features(texts: Texts) -> np.ndarray:
    """One row of N_FEATURES per text."""
    n = len(texts)
    sizes = np.maximum(texts.sizes, 1)[:, None]
    owner = np.repeat(np.arange(n, dtype=np.int64) * 256, texts.sizes)
    bytes_ = np.bincount(owner + texts.data, minlength=256 * n).reshape(n, 256)
    words = texts.words
    n_words = np.maximum(words.counts, 1)
    lines, repeated, closed = line_counts(texts)
    more = np.stack(
        [
            np.log1p(words.counts) / 10,
            np.bincount(words.owner, words.ends - words.starts, n) / n_words / 20,
            np.log1p(lines) / 10,
            repeated / np.maximum(lines, 1),
            closed / np.maximum(lines, 1),
            repeated_window_words(texts) / n_words,
        ],
        1,
    )
    return np.concatenate([np.sqrt(bytes_ / sizes), more], 1).astype(np.float32)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    centre: np.ndarray
    scale: np.ndarray
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(((rows - self.centre) / self.scale) @ self.weights + self.bias)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class _Adam:
    def __init__(self, size: int):
        self.m, self.v, self.t = np.zeros(size), np.zeros(size), 0

    def step(self, slope: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * slope
        self.v = 0.999 * self.v + 0.001 * slope**2
        return RATE * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _with_one(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.ones((len(rows), 1))], 1)


def _fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> np.ndarray:
    """Weights that minimise prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)), logistic loss."""
    random = np.random.default_rng(seed)
    weights, adam = np.zeros(positive.shape[1]), _Adam(positive.shape[1])
    for _ in range(EPOCHS):
        order = random.permutation(len(unlabelled))
        for at in range(0, len(order), BATCH):
            u = unlabelled[order[at : at + BATCH]]
            p = positive[random.integers(0, len(positive), BATCH)]
            sp, su = _sigmoid(p @ weights), _sigmoid(u @ weights)
            as_positive = -prior * ((1 - sp) @ p) / len(p)
            as_negative = (su @ u) / len(u) - prior * (sp @ p) / len(p)
            risk = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
            # below zero the negative part is overfitted: only undo that
            slope = as_positive + as_negative if risk >= 0 else -as_negative
            weights -= adam.step(slope + DECAY * weights)
    return weights


def _plain_fit(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 5) -> np.ndarray:
    """Weights that tell positives from unlabelled texts, each half of the loss."""
    random = np.random.default_rng(seed)
    weights, adam = np.zeros(positive.shape[1]), _Adam(positive.shape[1])
    for _ in range(EPOCHS // 2):
        for _ in range(0, len(unlabelled), BATCH):
            p, u = (x[random.integers(0, len(x), BATCH)] for x in (positive, unlabelled))
            slope = (_sigmoid(u @ weights) @ u - (1 - _sigmoid(p @ weights)) @ p) / BATCH
            weights -= adam.step(slope + 10 * DECAY * weights)
    return weights


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The largest share of positives the unlabelled scores allow: min over t of U(score >= t) / P(score >= t)."""
    grid = np.quantile(positive, np.linspace(0, 1 - TAIL, 60))
    p = 1 - np.searchsorted(np.sort(positive), grid, side="left") / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), grid, side="left") / len(unlabelled)
    spread = np.sqrt(np.log(20) / (2 * len(positive))) + np.sqrt(np.log(20) / (2 * len(unlabelled)))
    at = int(np.argmin((u + spread) / p))
    return float(np.clip(u[at] / p[at], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """A model from feature rows. The prior is estimated on the half of the rows that the first model did not see."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(N_FEATURES), 0.0, np.zeros(N_FEATURES), np.ones(N_FEATURES), 0.5)
    centre, scale = unlabelled.mean(0), unlabelled.std(0) + 0.01
    p, u = (_with_one((x - centre) / scale) for x in (positive, unlabelled))
    first = _plain_fit(p[::2], u[::2])
    prior = estimated_prior(p[1::2] @ first, u[1::2] @ first) if len(p) > 1 and len(u) > 1 else 0.5
    weights = _fit(p, u, prior)
    return Model(weights[:-1], float(weights[-1]), centre, scale, prior)


def rows_of(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the features as one binary of float32."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            rows = features(Texts.of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in rows], pa.binary())], names=[key, "features"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).alias("text")).mapInArrow(measure, f"`{key}` {kind}, features binary")


def learn(docs: DataFrame, positives: DataFrame, key: str = "doc_id", text: str = "text", n_positive: int = POSITIVES, n_unlabelled: int = UNLABELLED) -> Model:
    """A model from ``positives``, a table of trusted ids, and ``docs`` as unlabelled texts."""
    order = F.xxhash64(key)
    trusted = positives.where(F.col(key).isNotNull()).select(key).distinct().orderBy(order, key).limit(n_positive)
    unlabelled = docs.where(F.col(key).isNotNull()).select(key).orderBy(order, key).limit(n_unlabelled)
    chosen = trusted.withColumn("trusted", F.lit(1)).unionAll(unlabelled.withColumn("trusted", F.lit(0)))
    chosen = chosen.groupBy(key).agg(F.max("trusted").alias("trusted"), F.min("trusted").alias("not_unlabelled"))
    both = docs.select(key, text).join(F.broadcast(chosen), key)  # at most n_positive + n_unlabelled ids
    sample = rows_of(both.select(key, text), key, text).join(F.broadcast(chosen), key).orderBy(order, key).collect()
    take = lambda rows: np.stack([np.frombuffer(x["features"], np.float32) for x in rows]) if rows else np.zeros((0, N_FEATURES))
    return train(take([x for x in sample if x["trusted"]]), take([x for x in sample if not x["not_unlabelled"]]))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, score and predicted (1 from 0.5 on) per row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slabs(batches):
            scores = model.scores(features(Texts.of(batch.column(1)))).astype(np.float64)
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "score", "predicted"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).alias("text")).mapInArrow(judge, f"`{key}` {kind}, score double, predicted int")
