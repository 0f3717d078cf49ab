"""Document quality by Bradley-Terry pairwise ranking.

Every document has a vector of text measures.  From labelled documents preference pairs (label 1 over label 0) are
drawn; the model P(a preferred to b) = sigmoid(w . (x_a - x_b)) is fitted by Newton steps on the logistic loss of
the feature differences (an intercept would cancel).  The linear score then gets its threshold as a quantile of the
labelled scores: the cut that agrees with most labels, the one nearest to the share of label 0 among equals.
Returned scores are sigmoid(linear score - threshold), so 0.5 is the threshold.

Fitting uses at most ``FIT_ROWS`` labelled rows (lowest hashes of doc_id, whatever the size of the table) outside
the held-out fold, and ``PAIRS_PER_ROW`` pairs for each; only their feature vectors reach the driver.  Labels,
language, source and doc_id are never inputs of a score.  Scoring reads every whole text.

Defined results: null texts score as empty ones; a document with contradicting labels counts with its lowest; null
labels are left out; with labels of one kind only, or none, every score is that side's (1 if none).  Rows that
repeat are scored alike.  A null doc_id is not held out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 20_000
PAIRS_PER_ROW = 8
RIDGE = 1e-3
FOLDS, HELD_OUT = 3, 1

FEATURES = ("words", "symbols", "bars", "shouts", "capitals", "repeats", "distinct", "length", "digits", "stops",
            "spread")


def features(text: str | None) -> list[float]:
    """Measures of one whole text, all scale-free but the first."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = len(text)
    distinct = len(set(words)) / n
    size = math.log1p(n)
    return [size,
            min(3.0, sum(map(text.count, "#$%&*~^")) / n),
            min(3.0, text.count("|") / n),
            min(3.0, text.count("!") / n),
            sum(map(str.isupper, words)) / n,
            sum(map(eq, words, words[1:])) / n,
            distinct,
            min(20.0, chars / n),
            sum(map(text.count, "0123456789")) / chars,
            min(3.0, text.count(".") / n),
            distinct * size]


@dataclass
class RankingModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def linear(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.linear(x) - self.threshold, -500, 500)))


def fit_pairs(difference: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights that maximise sum(log sigmoid(w . d)) - RIDGE |w|^2 / 2 per pair, by damped Newton steps."""
    n, k = difference.shape
    w = np.zeros(k)

    def loss(w):
        return np.logaddexp(0.0, -difference @ w).mean() + RIDGE * (w @ w) / 2

    now = loss(w)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(np.clip(difference @ w, -500, 500)))
        gradient = -(difference.T @ p) / n + RIDGE * w
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / n + RIDGE * np.eye(k)
        step, rate = np.linalg.solve(hessian, gradient), 1.0
        while rate > 1e-6 and (then := loss(w - rate * step)) > now:
            rate /= 2
        if rate <= 1e-6 or now - then < 1e-10:
            break
        w, now = w - rate * step, then
    return w


def quantile_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """Midway between the two ordered scores at the quantile that agrees with most labels."""
    order = np.argsort(scores, kind="stable")
    s, y = scores[order], labels[order]
    below = np.concatenate([[0], np.cumsum(y == 0)])                   # label 0 under each cut
    above = np.concatenate([[0], np.cumsum((y == 1)[::-1])])[::-1]     # label 1 over it
    agrees = below + above
    edge = np.concatenate([[True], s[1:] > s[:-1], [True]])            # a cut cannot part equal scores
    best = np.flatnonzero(edge & (agrees == agrees[edge].max()))
    cut = best[np.abs(best - (y == 0).sum()).argmin()]
    if cut == 0:
        return float(s[0]) - 1.0
    return float(s[-1]) + 1.0 if cut == len(s) else float(s[cut - 1] + s[cut]) / 2


def fit(x: np.ndarray, labels: np.ndarray, seed: int = 7) -> RankingModel:
    good, bad = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(x):
        x = np.zeros((1, len(FEATURES)))
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    if not len(good) or not len(bad):
        return RankingModel(mean, scale, np.zeros(x.shape[1]), 20.0 if len(bad) else -20.0)
    z = (x - mean) / scale
    draw = np.random.default_rng(seed)
    a = np.concatenate([np.repeat(good, PAIRS_PER_ROW), draw.choice(good, len(bad) * PAIRS_PER_ROW)])
    b = np.concatenate([draw.choice(bad, len(good) * PAIRS_PER_ROW), np.repeat(bad, PAIRS_PER_ROW)])
    weights = fit_pairs(z[a] - z[b])
    return RankingModel(mean, scale, weights, quantile_threshold(z @ weights, labels))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> RankingModel:
    """Fit on at most ``limit`` labelled documents outside the held-out fold."""
    chosen = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.min("quality").alias("__label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    vector = F.pandas_udf(lambda t: pd.Series([features(x) for x in t]), "array<double>")
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .join(F.broadcast(chosen), "doc_id")                       # bounded by ``limit`` rows of two numbers
            .select("doc_id", "__label", vector("text").alias("x"))
            .groupBy("doc_id").agg(F.min("__label").alias("y"), F.min("x").alias("x"))   # repeated ids count once
            .orderBy("doc_id").toPandas())
    x = np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["y"].to_numpy())


def score_column(model: RankingModel, text: str = "text") -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = np.array([features(t) for t in batch], dtype=float).reshape(len(batch), len(FEATURES))
            yield pd.Series(model.score(x))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "double")(F.col(text).cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(train(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score 0.5 or more, with all their columns."""
    return docs.where(score_column(train(docs, labels)) >= 0.5)
