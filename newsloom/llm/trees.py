"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    def __init__(self, n_trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 1.0):
        self.n_trees, self.depth, self.rate, self.bins, self.least = n_trees, depth, rate, bins, least
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(width)], axis=1)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(n, self.base)
        for _ in range(self.n_trees):
            q = 1 / (1 + np.exp(-score))
            g, h = y - q, q * (1 - q)
            size = 2 ** (self.depth + 1) - 1
            feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
            node = np.zeros(n, dtype=np.int64)
            for k in range(2**self.depth - 1):
                own = np.flatnonzero(node == k)
                if len(own) < 2:
                    continue
                total_g, total_h, best = g[own].sum(), h[own].sum(), (1e-6, -1, 0)
                for j in range(width):
                    if not len(edges[j]):
                        continue
                    m = len(edges[j]) + 1
                    gl = np.cumsum(np.bincount(binned[own, j], g[own], m))[:-1]
                    hl = np.cumsum(np.bincount(binned[own, j], h[own], m))[:-1]
                    gain = gl**2 / (hl + self.least) + (total_g - gl) ** 2 / (total_h - hl + self.least) - total_g**2 / (total_h + self.least)
                    b = int(np.argmax(gain))
                    if gain[b] > best[0]:
                        best = (gain[b], j, b)
                if best[1] >= 0:
                    feature[k], cut[k] = best[1], edges[best[1]][best[2]]
                    right = x[own, best[1]] > cut[k]
                    node[own] = 2 * k + 1 + right
            for k in range(size):
                own = node == k
                if own.any():
                    value[k] = self.rate * g[own].sum() / (h[own].sum() + self.least)
            score += value[node]
            self.trees.append((feature, cut, value))
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                right = x[rows, np.maximum(f, 0)] > cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            score += value[node]
        return 1 / (1 + np.exp(-score))


def threshold_for(probability: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest threshold that reaches `precision` on held-out rows; above 1 if none does."""
    order = np.argsort(-probability, kind="stable")
    p, hits = probability[order], np.cumsum(y[order])
    last = np.append(p[:-1] != p[1:], True) if len(p) else np.zeros(0, bool)
    good = last & (hits >= precision * np.arange(1, len(p) + 1))
    return float(p[np.flatnonzero(good)[-1]]) if good.any() else 2.0
