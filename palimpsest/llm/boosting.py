"""Gradient-boosted trees for two classes on binned features, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Tree:
    """A complete tree: node i has children 2i+1 (value <= cut) and 2i+2; ``feature`` is -1 where no split helps."""

    feature: list[int]
    cut: list[float]
    leaf: list[float]


@dataclass
class Boosted:
    base: float
    depth: int
    trees: list[Tree] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for each row of features."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in self.trees:
            node = np.zeros(len(x), np.int64)
            feature, cut = np.array(t.feature), np.array(t.cut)
            for _ in range(self.depth):
                f = feature[node]
                right = (f >= 0) & (x[rows, np.maximum(f, 0)] > cut[node])
                node = 2 * node + 1 + right
            out += np.array(t.leaf)[node - (2**self.depth - 1)]
        return out


def sigmoid(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, least: int = 10, ridge: float = 1.0) -> Boosted:
    """Newton boosting on the log loss. x: rows by features; y: 0 or 1. One class or no rows: the base rate alone."""
    p = (y.sum() + 0.5) / (len(y) + 1)
    model = Boosted(float(np.log(p / (1 - p))), depth)
    if len(y) < 2 * least or not 0 < y.sum() < len(y):
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), model.base)
    inner = 2**depth - 1
    for _ in range(trees):
        p = sigmoid(margin)
        g, h = y - p, p * (1 - p)
        tree = Tree([-1] * inner, [0.0] * inner, [])
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            for i in range(2**level - 1, 2 ** (level + 1) - 1):
                at = np.flatnonzero(node == i)
                best = (1e-6, -1, 0)
                total_g, total_h = g[at].sum(), h[at].sum()
                for j, c in enumerate(cuts if len(at) >= 2 * least else []):
                    b = binned[at, j]
                    sums = [np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g[at], h[at], None)]
                    lg, lh, ln = sums
                    if not len(lg):
                        continue
                    gain = lg**2 / (lh + ridge) + (total_g - lg) ** 2 / (total_h - lh + ridge) - total_g**2 / (total_h + ridge)
                    gain[(ln < least) | (len(at) - ln < least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, k)
                if best[1] >= 0:
                    tree.feature[i], tree.cut[i] = best[1], float(cuts[best[1]][best[2]])
                    node[at] = 2 * i + 1 + (binned[at, best[1]] > best[2])
                else:
                    node[at] = 2 * i + 1
        leaf = node - inner
        sums_g, sums_h = (np.bincount(leaf, w, 2**depth) for w in (g, h))
        tree.leaf = (rate * sums_g / (sums_h + ridge)).tolist()
        margin += np.array(tree.leaf)[leaf]
        model.trees.append(tree)
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function nearest to ``y`` (pool adjacent violators), for linear interpolation."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # sum of y, count, sum of scores
    for s, t in zip(score[order].tolist(), y[order].tolist(), strict=True):
        pools.append([t, 1, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    if not pools:
        return np.array([0.0]), np.array([0.5])
    # Half an observation of each class in a pool keeps 0 and 1 out of reach of few rows.
    mean = np.array([(p[0] + 0.5) / (p[1] + 1) for p in pools])
    return np.array([p[2] / p[1] for p in pools]), np.maximum.accumulate(mean)
