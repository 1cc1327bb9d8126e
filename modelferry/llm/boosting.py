"""Gradient-boosted trees for two classes, in numpy: histograms, logistic loss, small trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Trees as arrays: each tree has 2^depth - 1 tests (feature, threshold) and 2^depth leaves."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - (2 ** self.depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 60, depth: int = 4,
        rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Trees of ``depth`` levels that lower the logistic loss step by step."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(d)], axis=1)
    p = float(np.average(y, weights=weight))
    p = min(max(p, 1e-6), 1 - 1e-6)
    base = float(np.log(p / (1 - p)))
    score = np.full(n, base)
    tests = 2 ** depth - 1
    out = Trees(base, depth, np.zeros((trees, tests), np.int64), np.full((trees, tests), np.inf), np.zeros((trees, tests + 1)))
    for k in range(trees):
        prob = 1 / (1 + np.exp(-score))
        g, h = weight * (y - prob), weight * prob * (1 - prob)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            at = node - first
            best = np.full(count, 1e-9)
            for j in range(d):
                size = len(cuts[j]) + 1
                if size < 2:
                    continue
                key = at * size + binned[:, j]
                gs = np.bincount(key, g, count * size).reshape(count, size).cumsum(axis=1)
                hs = np.bincount(key, h, count * size).reshape(count, size).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
                pick = gain.argmax(axis=1)
                top = gain[np.arange(count), pick]
                better = top > best
                best[better] = top[better]
                out.feature[k, first:first + count][better] = j
                out.threshold[k, first:first + count][better] = cuts[j][pick[better]]
            f, t = out.feature[k, node], out.threshold[k, node]
            node = 2 * node + 1 + (x[np.arange(n), f] > t)
        at = node - tests
        out.leaf[k] = rate * np.bincount(at, g, tests + 1) / (np.bincount(at, h, tests + 1) + ridge)
        score += out.leaf[k][at]
    return out
