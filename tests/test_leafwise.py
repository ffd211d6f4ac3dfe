"""Leaf-wise boosting against a plain one-machine grower on the same bins."""

import numpy as np
import pytest

from shelfcast.operators import leafwise


def plain_boost(x, y, cuts, rounds, rate, leaves, min_leaf):
    """Best-first growth by trying every split of every leaf on the rows themselves."""
    bins = np.stack([np.where(np.isnan(x[:, f]), len(cuts[f]) + 1, np.searchsorted(cuts[f], x[:, f], side="right")) for f in range(x.shape[1])], 1)
    pred = np.full(len(y), y.mean())
    trees = []
    for _ in range(rounds):
        g = pred - y
        where = {0: np.arange(len(y))}

        def best(rows):
            top = (-np.inf, -1, -1)
            total = g[rows].sum()
            for f in range(x.shape[1]):
                for t in range(len(cuts[f]) + 1):
                    left = rows[bins[rows, f] <= t]
                    right = rows[bins[rows, f] > t]
                    if len(left) < min_leaf or len(right) < min_leaf:
                        continue
                    gain = g[left].sum() ** 2 / len(left) + g[right].sum() ** 2 / len(right) - total**2 / len(rows)
                    if gain > top[0]:
                        top = (gain, f, t)
            return top

        splits = {0: best(where[0])}
        nodes, next_id = {}, 1
        while len(where) < leaves:
            open_ = [k for k in where if splits[k][0] > 0]
            if not open_:
                break
            k = max(open_, key=lambda k: (splits[k][0], -k))
            gain, f, t = splits.pop(k)
            rows = where.pop(k)
            nodes[k] = (f, t, next_id, next_id + 1)
            where[next_id], where[next_id + 1] = rows[bins[rows, f] <= t], rows[bins[rows, f] > t]
            splits[next_id], splits[next_id + 1] = best(where[next_id]), best(where[next_id + 1])
            next_id += 2
        for k, rows in where.items():
            pred[rows] += rate * -g[rows].sum() / len(rows)
        trees.append((nodes, sorted(where)))
    return pred, trees


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(5)
    n = 400
    x = np.stack([rng.integers(0, 7, n).astype(float), rng.normal(size=n), rng.integers(0, 3, n).astype(float)], 1)
    x[rng.random(n) < 0.05, 1] = np.nan
    y = 3 * (x[:, 0] > 2) + np.where(np.isnan(x[:, 1]), 5, x[:, 1]) ** 2 + 2 * x[:, 2] + rng.normal(size=n) * 0.1
    rows = [(int(i), *[None if np.isnan(v) else float(v) for v in x[i]], float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    return df, x, y


def test_equals_plain_grower(small):
    df, x, y = small
    booster = leafwise.fit(df, ["a", "b", "c"], "y", rounds=4, rate=0.3, leaves=7, bins=16, min_leaf=5)
    pred, trees = plain_boost(x, y, booster.cuts, 4, 0.3, 7, 5)
    got = np.array([r.prediction for r in booster.predict(df).orderBy("id").collect()])
    assert np.allclose(got, pred, atol=1e-9)
    assert [t.nodes for t in booster.trees] == [nodes for nodes, _ in trees]
    assert max(booster.leaves()) <= 7
    assert len({t.depth() for t in booster.trees}) >= 1 and any(t.depth() < len(t.nodes) for t in booster.trees)


def test_prefix_equals_shorter_fit_and_errors_per_round(small):
    df, _, _ = small
    full = leafwise.fit(df, ["a", "b", "c"], "y", rounds=6, rate=0.2, leaves=5, bins=16, min_leaf=5)
    short = leafwise.fit(df, ["a", "b", "c"], "y", rounds=3, rate=0.2, leaves=5, bins=16, min_leaf=5)
    assert [t.nodes for t in full.prefix(3).trees] == [t.nodes for t in short.trees]
    one = [r.prediction for r in full.prefix(3).predict(df).orderBy("id").collect()]
    two = [r.prediction for r in short.predict(df).orderBy("id").collect()]
    assert np.allclose(one, two)
    errs = leafwise.errors(full, df, "y")
    direct = [r.e for r in full.prefix(4).predict(df).selectExpr("avg((prediction - y) * (prediction - y)) AS e").collect()]
    assert len(errs) == 6 and errs == sorted(errs, reverse=True) and abs(errs[3] - direct[0]) < 1e-9


def test_empty_and_constant(spark):
    empty = spark.createDataFrame([], "a double, y double")
    assert leafwise.fit(empty, ["a"], "y", rounds=2).trees == []
    flat = spark.createDataFrame([(float(i), 1.0) for i in range(50)], "a double, y double")
    booster = leafwise.fit(flat, ["a"], "y", rounds=2)
    assert [r.prediction for r in booster.predict(flat).collect()] == [1.0] * 50
