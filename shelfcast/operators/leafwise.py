"""Leaf-wise boosted regression trees grown from histograms that Spark aggregates.

Squared loss, as the public leaf-wise boosters define it: the first prediction is the mean target; every
round fits one tree to the gradients ``prediction - target`` and adds ``rate`` times its leaf values
``-sum(g) / (rows + l2)``.

A tree grows best first: of all current leaves the one whose best split gains most is split next, until
it has ``leaves`` leaves or no split gains. A split compares a feature's bin with a threshold; bins are
the buckets of cut points drawn once per feature from all training rows (at most ``bins`` buckets, the
distinct values themselves when there are no more); missing values form a last bucket that goes right.

Each histogram is one aggregate over the rows, grouped by (leaf, feature, bin) with map-side partial
sums, so what reaches the driver is bounded by leaves x features x bins, never by rows. A pass computes
the left-child histograms of every open leaf whose children are not known yet, under that leaf's best
split; right children are the parent minus the left. Splitting a leaf whose children are known needs no
pass, so a tree of 31 leaves costs about as many passes as it is deep.

The row state (bins, target, prediction) is kept in memory and written to the shared folder every
``store_every`` rounds, so a lost executor recomputes at most that many rounds.

``errors`` gives the squared error of every prefix of the ensemble in one pass; ``prefix(k)`` is the model
of the first ``k`` trees, which equals a model fitted with ``k`` rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import settle


@dataclass
class Tree:
    """Internal nodes ``node -> (feature, bin, left, right)``, leaf values and split gains."""

    nodes: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)
    gains: list[tuple[int, float]] = field(default_factory=list)

    def route(self, bins: Sequence[Column], outcome) -> Column:
        """Expression of ``outcome(leaf)`` for the leaf a row reaches."""

        def at(node: int) -> Column:
            if node not in self.nodes:
                return outcome(node)
            feature, cut, left, right = self.nodes[node]
            return F.when(bins[feature] <= cut, at(left)).otherwise(at(right))

        return at(0)

    def depth(self, node: int = 0) -> int:
        if node not in self.nodes:
            return 0
        return 1 + max(self.depth(self.nodes[node][2]), self.depth(self.nodes[node][3]))


@dataclass
class Booster:
    features: list[str]
    cuts: list[list[float]]
    start: float
    rate: float
    trees: list[Tree]

    def prefix(self, k: int) -> Booster:
        return Booster(self.features, self.cuts, self.start, self.rate, self.trees[:k])

    def binned(self, df: DataFrame) -> tuple[DataFrame, list[Column]]:
        return bin_columns(df, self.features, self.cuts)

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the prediction of every row."""
        binned, bins = self.binned(df)
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + tree.route(bins, lambda leaf, t=tree: F.lit(self.rate * t.values[leaf]))
        return binned.withColumn(out, total).drop(*[f"__bin{i}" for i in range(len(self.features))])

    def importance(self, kind: str = "split") -> list[float]:
        """Splits per feature (``split``) or their summed gains (``gain``)."""
        found = [0.0] * len(self.features)
        for tree in self.trees:
            for feature, gain in tree.gains:
                found[feature] += 1.0 if kind == "split" else gain
        return found

    def leaves(self) -> list[int]:
        return [len(t.values) for t in self.trees]


def bin_columns(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> tuple[DataFrame, list[Column]]:
    """Bins ``__bin<i>``: bucket of ``[-inf, cut_1, ..., inf)``; missing values get the last bucket."""
    names = [f"__bin{i}" for i in range(len(features))]
    prepared = df.withColumns({f"__x{i}": F.col(f"`{c}`").cast("double") for i, c in enumerate(features)})
    bucketizer = Bucketizer(
        # a feature without cuts still needs three bounds: its finite values share bucket 0
        splitsArray=[[-float("inf"), *(c or [sys.float_info.max]), float("inf")] for c in cuts],
        inputCols=[f"__x{i}" for i in range(len(features))],
        outputCols=names,
        handleInvalid="keep",
    )
    binned = bucketizer.transform(prepared.fillna(float("nan"), subset=[f"__x{i}" for i in range(len(features))]))
    binned = binned.withColumns({n: F.col(n).cast("int") for n in names}).drop(*[f"__x{i}" for i in range(len(features))])
    return binned, [F.col(n) for n in names]


def find_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Cut points of every feature in one aggregate: the distinct values when there are at most ``bins``,
    else quantiles (approximate within 1 / (100 * bins) of rank); only distinct, increasing ones."""
    exprs = []
    for i, c in enumerate(features):
        x = F.col(f"`{c}`").cast("double")
        x = F.when(~F.isnan(x), x)
        exprs.append(F.count_distinct(x).alias(f"n{i}"))
        exprs.append(F.percentile_approx(x, [q / bins for q in range(1, bins)], 100 * bins).alias(f"q{i}"))
    row = df.agg(*exprs).first()
    few = [i for i in range(len(features)) if row[f"n{i}"] <= bins]
    small = {}
    if few:
        picked = df.select(*[F.col(f"`{features[i]}`").cast("double").alias(f"v{i}") for i in few])
        # at most ``bins`` values per feature reach the driver
        got = picked.agg(*[F.array_sort(F.collect_set(F.when(~F.isnan(f"v{i}"), F.col(f"v{i}")))).alias(f"v{i}") for i in few]).first()
        small = {i: got[f"v{i}"] for i in few}
    cuts = []
    for i in range(len(features)):
        if i in small:
            values = small[i]
            cuts.append([(a + b) / 2 for a, b in zip(values, values[1:])])
        else:
            cuts.append(sorted({v for v in (row[f"q{i}"] or []) if v is not None}))
    return cuts


def best_split(g: np.ndarray, n: np.ndarray, min_leaf: int, l2: float) -> tuple[float, int, int]:
    """``(gain, feature, bin)`` of the best split of one leaf's histograms (features x buckets); the last
    bucket is the missing one and always goes right. Ties go to the lower feature, then the lower bin."""
    total_g, total_n = g[0].sum(), n[0].sum()
    parent = total_g * total_g / (total_n + l2)
    left_g, left_n = np.cumsum(g[:, :-1], axis=1), np.cumsum(n[:, :-1], axis=1)
    right_g, right_n = total_g - left_g, total_n - left_n
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_g**2 / (left_n + l2) + right_g**2 / (right_n + l2) - parent
    gain[(left_n < min_leaf) | (right_n < min_leaf)] = -np.inf
    if gain.size == 0:
        return -np.inf, -1, -1
    flat = int(np.argmax(gain))
    feature, cut = divmod(flat, gain.shape[1])
    return float(gain[feature, cut]), feature, cut


def fit(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    rounds: int = 100,
    rate: float = 0.05,
    leaves: int = 31,
    bins: int = 255,
    min_leaf: int = 20,
    l2: float = 0.0,
    store_every: int = 10,
) -> Booster:
    """Boost ``rounds`` leaf-wise trees on all rows of ``df``; rows with a null target are left out."""
    features = list(features)
    rows = df.where(F.col(f"`{target}`").isNotNull())
    cuts = find_cuts(rows, features, bins)
    width = max(len(c) for c in cuts) + 2 if cuts else 2
    binned, bins_ = bin_columns(rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*features, target])]), features, cuts)
    state = binned.select(*bins_, F.col(f"`{target}`").cast("double").alias("__y"))
    start = state.agg(F.avg("__y")).first()[0]
    booster = Booster(features, cuts, float(start) if start is not None else 0.0, rate, [])
    if start is None:
        return booster
    bins_ = [F.col(f"__bin{i}") for i in range(len(features))]
    state = state.withColumn("__p", F.lit(booster.start)).persist(StorageLevel.MEMORY_AND_DISK)
    for r in range(rounds):
        tree = _grow(state, bins_, width, leaves, min_leaf, l2)
        booster.trees.append(tree)
        step = tree.route(bins_, lambda leaf: F.lit(rate * tree.values[leaf]))
        moved = state.withColumn("__p", F.col("__p") + step)
        moved = settle(moved, "boosting") if (r + 1) % store_every == 0 else moved.persist(StorageLevel.MEMORY_AND_DISK)
        moved.count()
        state.unpersist()
        state = moved
    state.unpersist()
    return booster


def _histograms(state: DataFrame, bins: list[Column], leaf: Column, left: Column, width: int, keys: int) -> dict:
    """Left-child histograms of the rows that ``left`` marks, by ``leaf``: ``{leaf: (g, n)}``."""
    g = F.col("__p") - F.col("__y")
    cells = state.where(left).select(
        leaf.alias("leaf"), g.alias("g"), F.posexplode(F.array(*bins)).alias("feature", "bin")
    )
    found = {}
    for row in cells.groupBy("leaf", "feature", "bin").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("n")).collect():
        hist = found.setdefault(row["leaf"], (np.zeros((keys, width)), np.zeros((keys, width))))
        hist[0][row["feature"], row["bin"]] = row["g"]
        hist[1][row["feature"], row["bin"]] = row["n"]
    return found


def _grow(state: DataFrame, bins: list[Column], width: int, leaves: int, min_leaf: int, l2: float) -> Tree:
    tree = Tree()
    keys = len(bins)
    empty = (np.zeros((keys, width)), np.zeros((keys, width)))
    hist = {0: _histograms(state, bins, F.lit(0), F.lit(True), width, keys).get(0, empty)}
    best = {0: best_split(*hist[0], min_leaf, l2)}
    children: dict[int, tuple] = {}
    next_id = 1
    while len(hist) < leaves:
        open_ = [k for k in hist if best[k][0] > 0]
        if not open_:
            break
        chosen = max(open_, key=lambda k: (best[k][0], -k))
        if chosen not in children:
            wanted = [k for k in open_ if k not in children]
            rule = {k: best[k] for k in wanted}
            leaf = tree.route(bins, lambda node: F.lit(node))
            left = F.lit(False)
            for k, (_, feature, cut) in rule.items():
                left = F.when(leaf == k, bins[feature] <= cut).otherwise(left)
            found = _histograms(state, bins, leaf, left, width, keys)
            for k in wanted:
                lg, ln = found.get(k, empty)
                children[k] = ((lg, ln), (hist[k][0] - lg, hist[k][1] - ln))
        gain, feature, cut = best[chosen]
        (lh, rh) = children.pop(chosen)
        left_id, right_id = next_id, next_id + 1
        next_id += 2
        tree.nodes[chosen] = (feature, cut, left_id, right_id)
        tree.gains.append((feature, gain))
        del hist[chosen], best[chosen]
        for node, h in ((left_id, lh), (right_id, rh)):
            hist[node] = h
            best[node] = best_split(*h, min_leaf, l2)
    for node, (g, n) in hist.items():
        tree.values[node] = float(-g[0].sum() / (n[0].sum() + l2)) if n[0].sum() + l2 > 0 else 0.0
    return tree


def errors(booster: Booster, df: DataFrame, target: str) -> list[float]:
    """Mean squared error of every prefix of the ensemble (1 to all trees) on ``df``, in one pass."""
    binned, bins = booster.binned(df.where(F.col(f"`{target}`").isNotNull()))
    if not booster.trees:
        return []
    steps = [t.route(bins, lambda leaf, t=t: F.lit(booster.rate * t.values[leaf])) for t in booster.trees]
    running = F.array(*steps)
    y = F.col(f"`{target}`").cast("double")
    gaps = binned.select(
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.lit(len(steps))),
                lambda k: F.pow(F.lit(booster.start) + F.aggregate(F.slice(running, 1, k), F.lit(0.0), lambda s, v: s + v) - y, 2),
            )
        ).alias("k", "sq")
    )
    got = {r["k"]: r["mse"] for r in gaps.groupBy("k").agg(F.avg("sq").alias("mse")).collect()}
    return [float(got[k]) for k in range(len(steps))]
