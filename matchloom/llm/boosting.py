"""Gradient-boosted trees for yes/no labels on small tables, in numpy; deterministic, and small enough to send with a task."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, trees of fixed depth on quantile bins. fit() takes a few thousand rows at most."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.bias, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.bias)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = y - p, p * (1 - p)
            node, tree = np.zeros(len(y), np.int64), []
            for level in range(self.depth):
                splits = []
                for k in range(1 << level):
                    inside = node == k
                    splits.append(self._split(binned[inside], gradient[inside], weight[inside], edges))
                tree.append(splits)
                feature, edge = np.array([s[0] for s in splits])[node], np.array([s[1] for s in splits])[node]
                node = 2 * node + (x[np.arange(len(x)), feature] > edge)
            size = 1 << self.depth
            leaf = self.rate * np.bincount(node, gradient, size) / (np.bincount(node, weight, size) + self.ridge)
            score += leaf[node]
            self.trees.append((tree, leaf))
        return self

    def _split(self, binned: np.ndarray, gradient: np.ndarray, weight: np.ndarray, edges: list[np.ndarray]) -> tuple[int, float]:
        best = (0.0, 0, np.inf)
        for f, e in enumerate(edges):
            if len(e) and len(gradient):
                g, h = (np.cumsum(np.bincount(binned[:, f], v, len(e) + 1)) for v in (gradient, weight))
                gain = g[:-1] ** 2 / (h[:-1] + self.ridge) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + self.ridge) - g[-1] ** 2 / (h[-1] + self.ridge)
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-12:
                    best = (float(gain[k]), f, float(e[k]))
        return best[1], best[2]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for tree, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for splits in tree:
                feature, edge = np.array([s[0] for s in splits])[node], np.array([s[1] for s in splits])[node]
                node = 2 * node + (x[rows, feature] > edge)
            out += leaf[node]
        return out
