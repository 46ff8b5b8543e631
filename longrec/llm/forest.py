"""A random forest for two classes in numpy: binned features, Gini splits, bootstrapped trees."""

from __future__ import annotations

import numpy as np

BINS = 32


class RandomForest:
    """Trees as flat arrays: feature (or -1 for a leaf), bin bound, right child; the left child follows its parent."""

    def __init__(self, trees: int = 60, depth: int = 10, least_leaf: int = 2, seed: int = 23):
        self.trees, self.depth, self.least_leaf, self.seed = trees, depth, least_leaf, seed
        self.bounds: np.ndarray | None = None
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, column, "left") for b, column in zip(self.bounds, x.T, strict=True)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> RandomForest:
        """``x`` rows x features without NaN, ``y`` 0 or 1; classes are weighed alike."""
        self.bounds = np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
        binned, rng = self._binned(x), np.random.default_rng(self.seed)
        weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1)) * len(y)
        tried = max(int(np.ceil(np.sqrt(x.shape[1]))), 1)
        for _ in range(self.trees):
            rows = rng.integers(len(y), size=len(y))
            tree: list[list[float]] = []
            self._grow(tree, binned, y, weight, rows, 0, tried, rng)
            feature, bound, right, value = (np.array(c) for c in zip(*tree, strict=True))
            self.nodes.append((feature.astype(np.int32), bound.astype(np.int32), right.astype(np.int32), value.astype(np.float64)))
        return self

    def _grow(self, tree, binned, y, weight, rows, depth, tried, rng) -> None:
        own, positive = weight[rows].sum(), (weight[rows] * y[rows]).sum()
        place = len(tree)
        tree.append([-1, 0, 0, positive / own])
        if depth >= self.depth or len(rows) < 2 * self.least_leaf or positive <= 0 or positive >= own:
            return
        best = (1e-12, None, None)
        for feature in rng.permutation(binned.shape[1])[:tried]:
            values = binned[rows, feature]
            total = np.bincount(values, weight[rows], BINS).cumsum()[:-1]
            ones = np.bincount(values, weight[rows] * y[rows], BINS).cumsum()[:-1]
            count = np.bincount(values, minlength=BINS).cumsum()[:-1]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = ones**2 / total + (total - ones) ** 2 / total
                gain += (positive - ones) ** 2 / (own - total) + (own - total - positive + ones) ** 2 / (own - total)
            gain = np.where((count >= self.least_leaf) & (len(rows) - count >= self.least_leaf), gain, -np.inf)
            gain -= (positive**2 + (own - positive) ** 2) / own
            bound = int(np.argmax(gain))
            if gain[bound] > best[0]:
                best = (gain[bound], feature, bound)
        if best[1] is None:
            return
        left = binned[rows, best[1]] <= best[2]
        tree[place][:2] = [best[1], best[2]]
        self._grow(tree, binned, y, weight, rows[left], depth + 1, tried, rng)
        tree[place][2] = len(tree)
        self._grow(tree, binned, y, weight, rows[~left], depth + 1, tried, rng)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The mean share of class 1 over the trees; 0.5 for a forest without trees."""
        if not self.nodes or not len(x):
            return np.full(len(x), 0.5)
        binned, total = self._binned(x), np.zeros(len(x))
        for feature, bound, right, value in self.nodes:
            at = np.zeros(len(x), np.int32)
            for _ in range(self.depth):
                inner = feature[at] >= 0
                goes_left = binned[np.arange(len(x)), np.maximum(feature[at], 0)] <= bound[at]
                at = np.where(inner, np.where(goes_left, at + 1, right[at]), at)
            total += value[at]
        return total / len(self.nodes)
