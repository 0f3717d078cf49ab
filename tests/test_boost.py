"""The regularised booster against a brute-force split search and its stopping rule."""

import random

import pytest

from demandcast.operators import boost
from demandcast.operators.boost import Penalty


def frame(spark, rows):
    return spark.createDataFrame(rows, "x0 double, x1 double, x2 double, y double")


def sample(n, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = [float(rng.randint(0, 9)), float(rng.randint(0, 4)), rng.choice([None, float("nan"), 1.0, 2.0])]
        out.append((*x, 3.0 * (x[0] > 5) + x[1] * (x[0] <= 2) + rng.choice([-0.25, 0.25])))
    return out


def brute_tree(rows, p, leaves, depth):
    """Best-first growth row by row: every feature, every value, both sums from the rows themselves."""
    def value(r, f):
        x = r[f]
        return -1e9 if x is None or x != x else x

    def sums(part):
        return sum(g for _, g in part), len(part)

    def score(g, h):
        t = max(abs(g) - p.alpha, 0.0)
        return t * t / (h + p.l2) if h + p.l2 else 0.0

    def best(part):
        found = None
        for f in range(3):
            for cut in sorted({value(r, f) for r, _ in part})[:-1]:
                left = [x for x in part if value(x[0], f) <= cut]
                right = [x for x in part if value(x[0], f) > cut]
                if min(len(left), len(right)) < max(p.child_weight, 1):
                    continue
                gain = 0.5 * (score(*sums(left)) + score(*sums(right)) - score(*sums(part))) - p.gamma
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = gain, left, right
        return found

    nodes = [(rows, 0)]
    while len(nodes) < leaves:
        offers = [(b, n) for n, (part, d) in enumerate(nodes) if d < depth and (b := best(part))]
        if not offers:
            break
        (_, left, right), n = max(offers, key=lambda o: o[0][0])
        d = nodes.pop(n)[1]
        nodes += [(left, d + 1), (right, d + 1)]
    out = {}
    for part, _ in nodes:
        g, h = sums(part)
        t = max(abs(g) - p.alpha, 0.0) * (1 if g > 0 else -1)
        for r, _ in part:
            out[tuple(repr(c) for c in r)] = -t / (h + p.l2)
    return out


@pytest.mark.parametrize("penalty, leaves, depth, at_once", [
    (Penalty(), 6, 8, 1), (Penalty(alpha=0.8, l2=0.7), 7, 8, 1), (Penalty(gamma=2.0, child_weight=12), 40, 3, 8)])
def test_tree_equals_brute_force(spark, penalty, leaves, depth, at_once):
    rows = sample(160)
    df = frame(spark, rows)
    model = boost.fit(df, None, ["x0", "x1", "x2"], "y", 1, 1.0, penalty, leaves, depth, 64, at_once)
    mean = sum(r[3] for r in rows) / len(rows)
    want = brute_tree([(r, mean - r[3]) for r in rows], penalty, leaves, depth)
    got = model.transform(df, ["x0", "x1", "x2"]).collect()
    assert len(model.trees[0].splits) > 1
    for r in got:
        assert r.prediction == pytest.approx(mean + want[tuple(repr(c) for c in r[:4])], abs=1e-9)


def test_fit_stops_when_patience_runs_out(spark):
    rng = random.Random(4)
    noise = lambda n: [(rng.random(), rng.random(), rng.random(), rng.gauss(0, 1)) for _ in range(n)]
    train, held = frame(spark, noise(150)), frame(spark, noise(150))
    model = boost.fit(train, held, ["x0", "x1", "x2"], "y", 40, 0.5, Penalty(l2=1.0), 8, 4, 16, 8, patience=3)
    best = min(range(len(model.errors)), key=model.errors.__getitem__)
    assert model.fitted == best + 1 + 3 < 40 and len(model.trees) == best + 1
    scored = model.transform(held, ["x0", "x1", "x2"]).selectExpr("avg(pow(prediction - y, 2))").first()[0]
    assert scored == pytest.approx(model.errors[best])


def test_empty_and_constant_tables(spark):
    empty = frame(spark, [])
    model = boost.fit(empty, None, ["x0", "x1"], "y", 2, 0.3)
    assert model.transform(frame(spark, [(1.0, None, None, 2.0)]), ["x0", "x1"]).first().prediction == 0.0
    same = frame(spark, [(1.0, 2.0, None, 5.0)] * 10)
    model = boost.fit(same, same, ["x0", "x1", "x2"], "y", 5, 0.3, patience=2)
    assert model.fitted == 3 and {r.prediction for r in model.transform(same, ["x0", "x1", "x2"]).collect()} == {5.0}
