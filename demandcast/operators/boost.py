"""Gradient boosting with second-order split gains, L1 / L2 / gamma and best-first growth, on DataFrames.

* bins: the edges of every feature come from one pass of quantile sketches (squared loss has hessian 1, so the
  hessian-weighted quantiles are the plain ones); the binned table is written once;
* histograms: sums of gradient and hessian per (leaf, feature, bin) are one partial aggregation, so what reaches the
  driver is leaves x features x bins, whatever the table holds; only the smaller child of a split is summed, the other
  is its parent minus it;
* growth: the open leaf of the greatest gain is split next (``at_once=1``: leaf-wise; more leaves share one pass over
  the table);
* rounds: the margin is a column of a table that is written every ``CARRY`` rounds; boosting goes on from it, and stops
  as soon as ``patience`` rounds have not lowered the error of the held-out rows.

A row goes left when its bin is at most the split's.  A missing feature value takes bin 0, below all edges.  Ties of gain
go to the smaller feature, then the smaller bin.  Without training rows the model predicts 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandcast.operators.panel import materialize, release, written_tables

CARRY = 4                       # rounds between two writings of the margin column
EDGE_ACCURACY = 10_000


@dataclass(frozen=True)
class Penalty:
    """Regularisation of the leaf weights and of the splits."""

    alpha: float = 0.0          # L1 on the leaf weight
    l2: float = 0.0             # L2 on the leaf weight
    gamma: float = 0.0          # least gain of a split
    child_weight: float = 1.0   # least hessian sum of a child

    def shrunk(self, g):
        return np.sign(g) * np.maximum(np.abs(g) - self.alpha, 0.0)

    def score(self, g, h):
        weight = h + self.l2
        return np.where(weight > 0, self.shrunk(g) ** 2 / np.where(weight > 0, weight, 1.0), 0.0)

    def leaf(self, g: float, h: float) -> float:
        return float(-self.shrunk(g) / (h + self.l2)) if h + self.l2 > 0 else 0.0


@dataclass
class Tree:
    """Nodes by number: a split (feature, bin, left, right) or a leaf's value."""

    splits: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def column(self, bins: Column, leaf, node: int = 0) -> Column:
        """The expression that takes a row's bins to ``leaf(node)`` of its leaf."""
        if node not in self.splits:
            return leaf(node)
        feature, at, left, right = self.splits[node]
        return F.when(bins[feature] <= at, self.column(bins, leaf, left)).otherwise(self.column(bins, leaf, right))

    def value(self, bins: Column) -> Column:
        return self.column(bins, lambda n: F.lit(self.values[n]))


@dataclass
class Model:
    edges: list[list[float]]
    base: float
    rate: float
    trees: list[Tree]
    errors: list[float]         # held-out squared error after each round fitted
    fitted: int                 # rounds fitted before patience ended the fit

    def transform(self, df: DataFrame, features: Sequence[str], name: str = "prediction") -> DataFrame:
        bins = F.array(*[bin_of(F.col(c), e) for c, e in zip(features, self.edges)])
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + F.lit(self.rate) * tree.value(F.col("__bins"))
        return df.withColumn("__bins", bins).withColumn(name, total).drop("__bins")


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Distinct quantiles of every feature as the upper edges of its bins, from one aggregate."""
    shares = [i / bins for i in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, EDGE_ACCURACY).alias(f"q{i}")
                   for i, c in enumerate(features)]).first()
    return [sorted(set(row[f"q{i}"] or [])) for i in range(len(features))]


def bin_of(value: Column, edges: Sequence[float]) -> Column:
    """Number of the first edge that is not below the value, from 1; 0 for a missing value."""
    x = value.cast("double")
    if not edges:
        return F.when(x.isNull() | F.isnan(x), 0).otherwise(1)
    array = F.array(*[F.lit(float(e)) for e in edges])
    return F.when(x.isNull() | F.isnan(x), 0).otherwise(F.size(F.filter(array, lambda e: e < x)) + 1)


def histograms(rows: DataFrame, node: Column, wanted: Sequence[int], features: int, bins: int) -> dict[int, np.ndarray]:
    """``wanted`` node -> (features, bins, 2) sums of gradient and hessian, in one pass over the rows."""
    sums = (rows.withColumn("__node", node).where(F.col("__node").isin(list(wanted)))
            .select("__node", "__g", F.posexplode("__bins").alias("f", "b"))
            .groupBy("__node", "f", "b").agg(F.sum("__g").alias("g"), F.count("*").alias("h")))
    out = {n: np.zeros((features, bins, 2)) for n in wanted}
    for r in sums.collect():                                    # leaves x features x bins
        out[r["__node"]][r.f, r.b] = r.g, r.h
    return out


def best_split(hist: np.ndarray, p: Penalty) -> tuple[float, int, int] | None:
    """(gain, feature, bin) of the best split of a node, None if no split gains."""
    left = hist.cumsum(axis=1)[:, :-1]
    total = hist.sum(axis=1)[:, None]
    right = total - left
    gain = 0.5 * (p.score(left[..., 0], left[..., 1]) + p.score(right[..., 0], right[..., 1])
                  - p.score(total[..., 0], total[..., 1])) - p.gamma
    least = max(p.child_weight, 1.0)                            # both children hold a row
    gain = np.where((left[..., 1] >= least) & (right[..., 1] >= least), gain, -np.inf)
    at = int(gain.argmax()) if gain.size else 0
    if not gain.size or gain.flat[at] <= 1e-9:
        return None
    feature, b = np.unravel_index(at, gain.shape)
    return float(gain.flat[at]), int(feature), int(b)


def grow(rows: DataFrame, features: int, bins: int, p: Penalty, leaves: int, depth: int, at_once: int = 1) -> Tree:
    """One tree over rows with ``__bins`` and the gradient ``__g``."""
    tree, hist = Tree(), histograms(rows, F.lit(0), [0], features, bins)
    level, found = {0: 0}, {0: best_split(hist[0], p)}
    while len(tree.splits) + 1 < leaves:
        open_ = sorted((n for n in found if found[n] and level[n] < depth), key=lambda n: (-found[n][0], n))
        taken = open_[:min(at_once, leaves - 1 - len(tree.splits))]
        if not taken:
            break
        smaller = {}
        for n in taken:
            _, feature, b = found.pop(n)
            a = len(level)
            tree.splits[n] = feature, b, a, a + 1
            level[a] = level[a + 1] = level[n] + 1
            less = hist[n][feature, :b + 1, 1].sum() <= hist[n][feature, b + 1:, 1].sum()
            smaller[n] = (a, a + 1) if less else (a + 1, a)
        node = tree.column(F.col("__bins"), F.lit)
        new = histograms(rows, node, [s for s, _ in smaller.values()], features, bins)
        for n, (small, large) in smaller.items():
            hist[small] = new[small]
            hist[large] = hist.pop(n) - new[small]              # the parent minus its smaller child
            for child in (small, large):
                found[child] = best_split(hist[child], p) if level[child] < depth else None
    tree.values = {n: p.leaf(*h[0].sum(axis=0)) for n, h in hist.items()}
    return tree


def fit(train: DataFrame, held: DataFrame | None, features: Sequence[str], label: str, rounds: int, rate: float,
        penalty: Penalty = Penalty(), leaves: int = 31, depth: int = 8, bins: int = 64, at_once: int = 1,
        patience: int | None = None) -> Model:
    """Boost squared loss; with ``held`` and ``patience`` no round is fitted after patience has run out.

    The model keeps the trees up to the best round on ``held``; ``fitted`` says how many were made.
    """
    edges = quantile_edges(train, features, bins)
    width = max((len(e) for e in edges), default=0) + 2
    binned = F.array(*[bin_of(F.col(c), e) for c, e in zip(features, edges)]).alias("__bins")
    sides = train.select(F.col(label).cast("double").alias("__y"), binned, F.lit(False).alias("__held"))
    if held is not None:
        sides = sides.unionByName(held.select(F.col(label).cast("double").alias("__y"), binned, F.lit(True).alias("__held")))
    before = set(written_tables())
    base = float(train.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0)
    table = materialize(sides.withColumn("__m", F.lit(base)), "parquet")
    trees: list[Tree] = []
    errors: list[float] = []
    best = -1
    for n in range(rounds):
        rows = table.where("NOT __held").select("__bins", (F.col("__m") - F.col("__y")).alias("__g"))
        trees.append(grow(rows, len(features), width, penalty, leaves, depth, at_once))
        table = table.withColumn("__m", F.col("__m") + F.lit(rate) * trees[-1].value(F.col("__bins")))
        if (n + 1) % CARRY == 0:
            table = materialize(table, "parquet")
        if held is not None:
            errors.append(float(table.where("__held").agg(F.avg((F.col("__m") - F.col("__y")) ** 2)).first()[0] or 0.0))
            if best < 0 or errors[n] < errors[best]:
                best = n
            elif patience is not None and n - best >= patience:
                break
    release(train.sparkSession, [path for path in written_tables() if path not in before])
    return Model(edges, base, rate, trees[:best + 1] if held is not None else trees, errors, len(trees))
