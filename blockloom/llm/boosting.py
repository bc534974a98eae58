"""Gradient boosted trees from histograms of all labelled rows, scored as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES, DEPTH, RATE, SMOOTH, MIN_LEAF = 30, 3, 0.3, 1.0, 5

#: (feature, threshold, left, right) or a leaf's value; left holds values up to the threshold.
Tree = tuple[int, float, "Tree", "Tree"] | float


#: What a pass over the rows sums up for each open leaf of the growing tree, feature and value: gradients, weights, rows.
#: It is told the trees so far, the growing tree with the numbers of its open leaves (others -1), and how many there are.
Histogram = Callable[[list[Tree], Tree, int], np.ndarray]
#: Gradients and weights are added up as multiples of this share, so that sums do not depend on their order.
GRAIN = 2**-24


@dataclass(eq=False)
class _Leaf:
    """A leaf and its sums, or what became of it."""

    g: float
    h: float
    n: float
    split: tuple[int, float, _Leaf, _Leaf] | None = None

    def tree(self, say: Callable[[_Leaf], float]) -> Tree:
        if self.split is None:
            return say(self)
        f, cut, left, right = self.split
        return f, cut, left.tree(say), right.tree(say)


def _split(cells: np.ndarray, values: Sequence[np.ndarray]) -> tuple[int, float, _Leaf, _Leaf] | None:
    """The best cut of a leaf, of features by values by sums."""
    left = np.cumsum(cells, axis=1)
    whole = left[:, -1:]
    right = whole - left
    worth = lambda x: x[..., 0] ** 2 / (x[..., 1] + SMOOTH)
    gain = worth(left) + worth(right) - worth(whole)
    gain[(left[..., 2] < MIN_LEAF) | (right[..., 2] < MIN_LEAF) | (cells[..., 2] == 0)] = 0
    f, at = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[f, at] <= 1e-6:
        return None
    onward = at + 1 + int(np.argmax(cells[f, at + 1 :, 2] > 0))
    return int(f), float(values[f][at] + values[f][onward]) / 2, _Leaf(*left[f, at]), _Leaf(*right[f, at])


def fit_cells(histogram: Histogram, values: Sequence[np.ndarray]) -> list[Tree]:
    """Trees whose values add up to the log odds of label 1, from ``DEPTH`` passes over
    all rows for each; ``values`` are those of each feature's cells, ascending."""
    g, _, n = histogram([0.0], 0.0, 1)[0, 0].sum(axis=0)
    share = np.clip(g / n + 0.5, 1e-4, 1 - 1e-4)
    trees: list[Tree] = [float(np.log(share / (1 - share)))]
    for _ in range(TREES):
        root = _Leaf(0, 0, 0)
        grown = [root]
        for level in range(DEPTH):
            number = {leaf: float(i) for i, leaf in enumerate(grown)}
            cells = histogram(trees, root.tree(lambda leaf: number.get(leaf, -1.0)), len(grown))  # noqa: B023
            if not level:
                root.g, root.h, root.n = cells[0, 0].sum(axis=0)
            for leaf, own in zip(grown, cells, strict=True):
                leaf.split = _split(own, values)
            grown = [leaf for x in grown if x.split for leaf in x.split[2:] if leaf.n >= 2 * MIN_LEAF]
            if not grown:
                break
        trees.append(root.tree(lambda leaf: float(RATE * leaf.g / (leaf.h + SMOOTH))))
    return trees


def _value(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, left, right = tree
    return np.where(x[:, f] <= cut, _value(left, x), _value(right, x))


def fit(x: np.ndarray, y: np.ndarray, times: np.ndarray | None = None) -> list[Tree]:
    """The same from rows at hand, each standing for ``times`` equal ones."""
    times = np.ones(len(y)) if times is None else times
    values, cell = zip(*(np.unique(x[:, f], return_inverse=True) for f in range(x.shape[1])), strict=True)
    most = max(map(len, values))

    def histogram(trees: list[Tree], growing: Tree, leaves: int) -> np.ndarray:
        p = 1 / (1 + np.exp(-log_odds(trees, x)))
        sums = [np.floor((y - p) * times / GRAIN + 0.5) * GRAIN, np.floor(p * (1 - p) * times / GRAIN + 0.5) * GRAIN, times]
        leaf = _value(growing, x).astype(int)
        inside = leaf >= 0
        count = lambda f, w: np.bincount(leaf[inside] * most + cell[f][inside], w[inside], leaves * most).reshape(leaves, most)
        return np.stack([np.stack([count(f, w) for w in sums], -1) for f in range(len(values))], 1)

    return fit_cells(histogram, values)


def fit_table(rows: DataFrame, features: Sequence[str], most: int) -> list[Tree]:
    """The same from a table of any size with ``label``, ``n`` (equal rows) and whole
    features from 0 to ``most``: a pass is one aggregation, of which the driver
    sees a cell per open leaf, feature and value."""
    feature = lambda f: F.col(features[f])

    def histogram(trees: list[Tree], growing: Tree, leaves: int) -> np.ndarray:
        p = 1 / (1 + F.exp(-F.col("odds")))
        grains = lambda c: F.floor(c * F.col("n") / F.lit(GRAIN) + 0.5)
        told = rows.withColumns({"odds": score(trees, feature), "leaf": score([growing], feature).cast("int")}).where("leaf >= 0")
        sums = told.withColumn("p", p).select("leaf", "n", grains(F.col("label") - F.col("p")).alias("g"), grains(F.col("p") * (1 - F.col("p"))).alias("h"), F.posexplode(F.array(*features)).alias("f", "v"))
        cells = np.zeros((leaves, len(features), most + 1, 3))
        for r in sums.groupBy("leaf", "f", "v").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).collect():
            cells[r.leaf, r.f, r.v] = r.g * GRAIN, r.h * GRAIN, r.n
        return cells

    return fit_cells(histogram, [np.arange(most + 1)] * len(features))


def log_odds(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    return sum((_value(t, x) for t in trees), np.zeros(len(x)))


def score(trees: list[Tree], feature: Callable[[int], Column]) -> Column:
    """The same as an expression."""

    def say(tree: Tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(tree)
        f, cut, left, right = tree
        return F.when(feature(f) <= cut, say(left)).otherwise(say(right))

    total = say(trees[0])
    for tree in trees[1:]:
        total = total + say(tree)
    return total


def threshold(odds: np.ndarray, y: np.ndarray, precision: float, times: np.ndarray | None = None) -> float | None:
    """The least log odds from which on held-out rows are right to the given
    share; none if no such point exists. A row may stand for ``times`` rows,
    ``y`` is then the share of label 1 among them."""
    order = np.argsort(-odds, kind="stable")
    times = np.ones(len(y)) if times is None else times
    right = np.cumsum((y * times)[order]) / np.cumsum(times[order])
    ends = np.append(odds[order][1:] != odds[order][:-1], True)  # not within ties
    good = np.flatnonzero((right >= precision) & ends)
    return float(odds[order][good[-1]]) if len(good) else None
