"""Gradient-boosted trees of depth two, fitted on a bounded sample and applied as a column expression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 24
RATE = 0.3
RIDGE = 1.0


@dataclass(frozen=True)
class Tree:
    """``feature <= cut`` goes left; a leaf has a value."""

    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def column(self, features: Sequence[Column]) -> Column:
        if self.feature < 0:
            return F.lit(self.value)
        under = features[self.feature] <= F.lit(self.cut)
        return F.when(under, self.left.column(features)).otherwise(self.right.column(features))

    def values(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.cut, self.left.values(x), self.right.values(x))


@dataclass(frozen=True)
class Boosted:
    bias: float
    trees: tuple[Tree, ...]

    def column(self, features: Sequence[Column]) -> Column:
        total = F.lit(self.bias)
        for tree in self.trees:
            total = total + tree.column(features)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + sum((t.values(x) for t in self.trees), np.zeros(len(x))))))


def _grown(x: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, depth: int) -> Tree:
    g, h = gradient.sum(), curvature.sum()
    leaf = Tree(float(RATE * g / (h + RIDGE)))
    if depth == 0 or len(x) < 2:
        return leaf
    best = (g * g / (h + RIDGE) + 1e-6, -1, 0.0)
    for feature in range(x.shape[1]):
        values, place = np.unique(x[:, feature], return_inverse=True)
        left_g = np.cumsum(np.bincount(place, gradient))[:-1]
        left_h = np.cumsum(np.bincount(place, curvature))[:-1]
        gains = left_g**2 / (left_h + RIDGE) + (g - left_g) ** 2 / (h - left_h + RIDGE)
        if len(gains) and gains.max() > best[0]:
            best = (float(gains.max()), feature, float(values[gains.argmax()]))
    if best[1] < 0:
        return leaf
    under = x[:, best[1]] <= best[2]
    children = [_grown(x[m], gradient[m], curvature[m], depth - 1) for m in (under, ~under)]
    return Tree(0.0, best[1], best[2], *children)


def fit_boosted(x: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, depth: int = 2) -> Boosted:
    """Newton boosting of the logistic loss; without rows every score is near zero."""
    if len(labels) == 0:
        return Boosted(-20.0, ())
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    total, trees = np.full(len(labels), bias), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        tree = _grown(x, labels - p, np.maximum(p * (1 - p), 1e-9), depth)
        trees.append(tree)
        total += tree.values(x)
    return Boosted(bias, tuple(trees))
