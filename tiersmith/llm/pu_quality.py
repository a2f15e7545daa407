"""Quality classifier by positive-unlabelled learning (operator 9).

A small network is fitted on trusted positives and documents of all kinds
(labelled or not, taken as unlabelled) by minimising the non-negative unbiased risk
``prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))``
with the sigmoid loss; where the bracket is negative, the step goes back up
its gradient.  The class prior is estimated from the labelled training rows.
The network's output is then calibrated on a bounded sample of labelled
training rows, so that the score reads as a probability.

Fitting takes bounded samples (``FIT_ROWS`` of each kind, chosen by a hash of
the id); scoring is one narrow pass over all texts.

Defined cases: null and blank texts score 0; without positives or without any
other rows every text with a word scores the prior (1 if there are no labels at
all); repeated rows score alike; other columns are ignored; texts
are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiersmith.llm.common import held_out, sample_key, tidied

# Bound of each sample that is fitted on: positives, negatives (calibration), unlabelled.
FIT_ROWS = 4000
# Score from which a text counts as good.
KEEP_SCORE = 0.7
HIDDEN, STEPS, BATCH = 24, 500, 256

# Character classes by byte, for shares of classes and of pairs of neighbours.
_CLASS = np.full(256, 6, np.uint16)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[32], _CLASS[[*range(9, 14)]] = 3, 4
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 5
_CLASS[[ord(c) for c in "#*$%&"]], _CLASS[[ord(c) for c in "|<>"]], _CLASS[ord("!")] = 7, 8, 9
_CLASS[192:], _CLASS[128:192] = 10, 11
N_CLASSES = 12
N_FEATURES = N_CLASSES * N_CLASSES + 8


def features(text: str | None) -> np.ndarray:
    """Square roots of the shares of neighbouring character classes, and
    measures of repetition and length."""
    out = np.zeros(N_FEATURES, np.float32)
    words = (text or "").split()
    if not words:
        return out
    codes = _CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    pairs = np.bincount(codes[:-1] * N_CLASSES + codes[1:], minlength=N_CLASSES * N_CLASSES)
    out[:-8] = np.sqrt(pairs / max(1, len(codes) - 1))
    n, lines = len(words), text.split("\n")
    distinct = len(set(words))
    out[-8:] = (
        min(1.0, distinct / n), np.sqrt(sum(map(eq, words, words[1:])) / n),
        np.sqrt(sum(map(eq, words, words[2:])) / n), np.sqrt(1 - len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2)) if n > 3 else 0,
        1 - len(set(lines)) / len(lines), np.log1p(n) / 10, min(3.0, len(text) / n / 8), np.log(distinct) / max(1.0, np.log(n)),
    )
    return out


class PuModel:
    """One hidden layer; ``fit`` minimises the non-negative risk."""

    def __init__(self, constant: float | None = None):
        self.constant = constant

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int = 7) -> PuModel:
        rng = np.random.default_rng(seed)
        both = np.concatenate([positive, unlabelled])
        self.mean, self.scale = both.mean(axis=0), both.std(axis=0) + 0.02
        p, u = self._norm(positive), self._norm(unlabelled)
        d = p.shape[1]
        weights = [rng.normal(0, d ** -0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, STEPS + 1):
            xp, xu = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
            x = np.concatenate([xp, xu])
            h = np.tanh(x @ weights[0] + weights[1])
            z = np.clip(h @ weights[2] + weights[3], -30, 30)
            as_positive = 1 / (1 + np.exp(z))  # sigmoid loss of the label +1; that of -1 is the rest
            slope = -as_positive * (1 - as_positive)
            negative_part = (1 - as_positive[BATCH:]).mean() - prior * (1 - as_positive[:BATCH]).mean()
            grad = np.zeros(2 * BATCH)
            if negative_part >= 0:
                grad[:BATCH] = 2 * prior * slope[:BATCH] / BATCH
                grad[BATCH:] = -slope[BATCH:] / BATCH
            else:  # the risk of negatives fell below zero: undo
                grad[:BATCH] = -prior * slope[:BATCH] / BATCH
                grad[BATCH:] = slope[BATCH:] / BATCH
            back = np.outer(grad, weights[2]) * (1 - h * h)
            grads = [x.T @ back + 1e-4 * weights[0], back.sum(axis=0), h.T @ grad + 1e-4 * weights[2], np.array([grad.sum()])]
            rate = 0.01 * (1 - 0.9 * step / STEPS)
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        self.weights, self.slope, self.offset = weights, 1.0, 0.0
        return self

    def _norm(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def margin(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(self._norm(x) @ w[0] + w[1]) @ w[2] + w[3]

    def calibrate(self, x: np.ndarray, y: np.ndarray, prior: float) -> PuModel:
        """Logistic scaling of the margin; classes weighted to the prior."""
        z, weight = self.margin(x), np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum()))
        a, b, spread = 1.0, 0.0, z.std() + 1e-6
        zs = (z - z.mean()) / spread
        for _ in range(3000):
            r = weight * (1 / (1 + np.exp(-np.clip(a * zs + b, -30, 30))) - y)
            a, b = a - 2.0 * ((r * zs).sum() + 1e-4 * a), b - 2.0 * r.sum()
        self.slope, self.offset = a / spread, b - a * z.mean() / spread
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.offset, -30, 30)))


def _features_udf():
    @tidied
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([features(t).tolist() for t in batch])

    return F.pandas_udf(run, "array<float>")


def _matrix(rows: DataFrame) -> np.ndarray:
    """Features of a bounded sample on the driver (a few MB; no texts), in an
    order of their own, so that fitting does not depend on how rows arrive."""
    got = sorted(r[0] for r in rows.select(_features_udf()("_text")).collect())
    return np.array(got, np.float32).reshape(-1, N_FEATURES)


def _others(texts: DataFrame, marks: DataFrame) -> bool:
    """Whether any text is not labelled good."""
    good = marks.where("_y = 1").select("_id")
    return bool(texts.select("_id").join(good, "_id", "left_anti").limit(1).count())


def fit_pu(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, label: str = "quality") -> PuModel:
    """Fit on documents whose id is not held out: at most ``3 * rows`` rows a kind."""
    marks = (labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_y"))
             .where(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out("_id"))
             .groupBy("_id").agg(F.min("_y").alias("_y")))
    counts = {r[0]: r[1] for r in marks.groupBy("_y").count().collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    prior = positives / (positives + negatives) if counts else 1.0
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).where(
        F.col("_id").isNotNull() & F.col("_text").isNotNull() & ~held_out("_id"))
    if not positives:
        return PuModel(prior)

    def share(n: int) -> float:
        return min(1.0, rows / max(1, n))

    known = {}
    for y, n in ((1, positives), (0, negatives)):
        # The sample of labels is bounded by ``3 * rows`` ids, so it may be broadcast.
        ids = marks.where((F.col("_y") == y) & (sample_key("_id") < share(n))).limit(3 * rows)
        known[y] = _matrix(texts.join(F.broadcast(ids), "_id").limit(3 * rows)) if n else np.zeros((0, N_FEATURES), np.float32)
    # The unlabelled side is drawn from all texts, labelled or not: that is the marginal that the risk is about.
    drawn = texts.where(sample_key("_id") < share(texts.count())).limit(3 * rows)
    if not len(known[1]) or not (len(known[0]) or _others(texts, marks)):
        return PuModel(prior)
    unlabelled = _matrix(drawn)
    if not len(unlabelled):
        return PuModel(prior)
    model = PuModel().fit(known[1], unlabelled, min(max(prior, 0.05), 0.95))
    if len(known[0]):
        x = np.concatenate([known[1], known[0]])
        model.calibrate(x, np.repeat([1, 0], [len(known[1]), len(known[0])]), min(max(prior, 0.05), 0.95))
    return model


def score_column(model: PuModel, text: str | Column = "text") -> Column:
    """Score of each text, 0 to 1."""
    @tidied
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([features(t) for t in batch], np.float32).reshape(-1, N_FEATURES)
            yield pd.Series(np.where(x.any(axis=1), model.score(x), 0.0))

    return F.pandas_udf(run, "double")(text)
