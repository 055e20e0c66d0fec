"""Small tree models for bounded training tables: histogram regression trees,
gradient boosting with logistic loss, and isotonic calibration. Training
tables are samples whose size is a parameter of the caller; scoring runs
inside tasks on whole batches."""

from __future__ import annotations

import numpy as np

BINS = 64


class Tree:
    """A binary tree in arrays; rows with ``x[feature] <= cut`` go left."""

    def __init__(self, nodes: list[tuple[int, float, int, int, float]]):
        cols = list(zip(*nodes))
        self.feature, self.left, self.right = (np.array(cols[i], "int32") for i in (0, 2, 3))
        self.cut, self.value = np.array(cols[1]), np.array(cols[4])

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), "int32")
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return self.value[at]
            left = x[np.arange(len(x)), np.maximum(f, 0)] <= self.cut[at]
            at = np.where(inner, np.where(left, self.left[at], self.right[at]), at)


def cuts_of(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Candidate cuts per feature: midpoints between its quantiles."""
    out = []
    for col in x.T:
        q = np.unique(np.quantile(col, np.linspace(0, 1, bins + 1), method="lower"))
        out.append((q[1:] + q[:-1]) / 2)
    return out


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], depth: int,
         min_rows: int, ridge: float = 1.0) -> Tree:
    """One tree for gradients ``g`` and curvatures ``h`` (leaf: g / (h + ridge))."""
    binned = np.column_stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T)])
    nodes: list = []

    def leaf_value(rows):
        return float(g[rows].sum() / (h[rows].sum() + ridge))

    def build(rows, d):
        at = len(nodes)
        nodes.append(None)
        best = (1e-9, -1, 0)
        if d and len(rows) >= 2 * min_rows:
            gs, hs = g[rows].sum(), h[rows].sum()
            base = gs * gs / (hs + ridge)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                b = binned[rows, f]
                n = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                gl = np.cumsum(np.bincount(b, g[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(c) + 1))[:-1]
                gain = gl ** 2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - base
                gain[(n < min_rows) | (len(rows) - n < min_rows)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (float(gain[k]), f, k)
        if best[1] < 0:
            nodes[at] = (-1, 0.0, 0, 0, leaf_value(rows))
            return at
        go = binned[rows, best[1]] <= best[2]
        left, right = build(rows[go], d - 1), build(rows[~go], d - 1)
        nodes[at] = (best[1], float(cuts[best[1]][best[2]]), left, right, 0.0)
        return at

    build(np.arange(len(x)), depth)
    return Tree(nodes)


class Boosted:
    """Gradient-boosted trees for a 0/1 label; ``raw`` is a log-odds."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3,
                 rate: float = 0.2, min_rows: int = 5):
        mean = min(max(float(y.mean()), 1e-4), 1 - 1e-4) if len(y) else 1e-4
        self.base, self.rate, self.trees = float(np.log(mean / (1 - mean))), rate, []
        if not len(y) or y.min() == y.max():
            return
        cuts, f = cuts_of(x), np.full(len(y), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-f))
            tree = grow(x, y - p, p * (1 - p), cuts, depth, min_rows)
            self.trees.append(tree)
            f += rate * tree.predict(x)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += self.rate * t.predict(x)
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares increasing fit of ``y`` on ``x`` by pooling adjacent
    violators: block centres and block means, for ``np.interp``."""
    order = np.lexsort((y, x))
    xs, first, n = np.unique(x[order], return_index=True, return_counts=True)
    means = np.add.reduceat(y[order].astype(float), first) / n if len(xs) else np.array([])
    blocks: list[list[float]] = []  # mean, weight, sum of x * weight
    for xv, m, w in zip(xs, means, n):
        blocks.append([float(m), float(w), float(xv) * w])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b = blocks.pop()
            a = blocks[-1]
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1] += b[1]
            a[2] += b[2]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] for b in blocks])
