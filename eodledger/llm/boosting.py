"""Gradient boosting of small trees for a yes-or-no question, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Boosted:
    """Trees of equal depth: at each level one feature and cut for each node, then a value a leaf."""

    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    cuts: np.ndarray | None = None
    start: float = 0.0
    grown: list = field(default_factory=list)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(self.cuts)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        marks = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = np.quantile(x, marks, axis=0).T
        rate = np.clip(y.mean(), 0.01, 0.99)
        self.start = float(np.log(rate / (1 - rate)))
        bins, score = self._binned(x), np.full(len(x), self.start)
        for _ in range(self.trees):
            p = sigmoid(score)
            tree = self._grow(bins, y - p, p * (1 - p))
            self.grown.append(tree)
            score += self._walk(tree, bins)
        return self

    def _grow(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple:
        node, features, limits = np.zeros(len(bins), np.int64), [], []
        for level in range(self.depth):
            n = 1 << level
            gains = np.full((bins.shape[1], n, BINS), -np.inf)
            for f in range(bins.shape[1]):
                at = node * BINS + bins[:, f]
                a = np.bincount(at, g, n * BINS).reshape(n, BINS).cumsum(axis=1)
                b = np.bincount(at, h, n * BINS).reshape(n, BINS).cumsum(axis=1)
                ta, tb = a[:, -1:], b[:, -1:]
                gains[f] = a**2 / (b + 1) + (ta - a) ** 2 / (tb - b + 1) - ta**2 / (tb + 1)
            best = gains.transpose(1, 0, 2).reshape(n, -1).argmax(axis=1)
            feature, limit = best // BINS, best % BINS
            features.append(feature)
            limits.append(limit)
            node = 2 * node + (bins[np.arange(len(bins)), feature[node]] > limit[node])
        n = 1 << self.depth
        leaf = self.rate * np.bincount(node, g, n) / (np.bincount(node, h, n) + 1)
        return features, limits, leaf

    def _walk(self, tree: tuple, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        for feature, limit in zip(tree[0], tree[1]):
            node = 2 * node + (bins[np.arange(len(bins)), feature[node]] > limit[node])
        return tree[2][node]

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = self._binned(x)
        return self.start + sum(self._walk(t, bins) for t in self.grown)


def temperature(margins: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the margins that makes their probabilities fit ``y`` best."""
    if not len(y):
        return 1.0
    tried = np.geomspace(0.25, 8, 60)
    p = sigmoid(margins[:, None] / tried).clip(1e-9, 1 - 1e-9)
    loss = -(y[:, None] * np.log(p) + (1 - y[:, None]) * np.log(1 - p)).mean(axis=0)
    return float(tried[loss.argmin()])
