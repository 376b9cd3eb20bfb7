"""Gradient-boosted trees on binned dense features, and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Complete trees of fixed depth under the logistic loss; splits are on quantile bins, leaves take Newton steps."""

    trees: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 64
    smooth: float = 1.0
    edges: list[np.ndarray] = field(default_factory=list)
    base: float = 0.0
    feature: np.ndarray | None = None  # tree x inner node
    cut: np.ndarray | None = None
    leaf: np.ndarray | None = None  # tree x leaf

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        rows, columns = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(columns)]
        self.edges = [np.unique(np.r_[e, np.quantile(x[y == 1, j], np.linspace(0, 1, 17)[1:-1])]) if (y == 1).any() else e for j, e in enumerate(self.edges)]
        b = self._binned(x)
        width = max(len(e) for e in self.edges) + 1
        share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = float(np.log(share / (1 - share)))
        raw = np.full(rows, self.base)
        inner = (1 << self.depth) - 1
        self.feature = np.zeros((self.trees, inner), np.int64)
        self.cut = np.full((self.trees, inner), width, np.int64)
        self.leaf = np.zeros((self.trees, 1 << self.depth))
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(rows, np.int64)
            for level in range(self.depth):
                first = (1 << level) - 1
                here = node - first
                n = 1 << level
                best = np.full(n, 1e-9)
                for j in range(columns):
                    key = here * width + b[:, j]
                    gs = np.bincount(key, weights=g, minlength=n * width).reshape(n, width).cumsum(axis=1)
                    hs = np.bincount(key, weights=h, minlength=n * width).reshape(n, width).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.smooth) + (gt - gs) ** 2 / (ht - hs + self.smooth) - gt**2 / (ht + self.smooth)
                    gain[:, -1] = 0
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(n), at]
                    for k in np.flatnonzero(top > best):
                        best[k] = top[k]
                        self.feature[t, first + k], self.cut[t, first + k] = j, at[k]
                right = b[np.arange(rows), self.feature[t, node]] > self.cut[t, node]
                node = 2 * node + 1 + right
            leaf = node - inner
            gs = np.bincount(leaf, weights=g, minlength=1 << self.depth)
            hs = np.bincount(leaf, weights=h, minlength=1 << self.depth)
            self.leaf[t] = self.rate * gs / (hs + self.smooth)
            raw += self.leaf[t, leaf]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        if self.feature is None:
            return np.full(len(x), self.base)
        b = self._binned(x)
        out = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        row = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[row, self.feature[t, node]] > self.cut[t, node])
            out += self.leaf[t, node - inner]
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots (score, mean label) of the best non-decreasing fit; between knots it is linear."""
    order = np.argsort(score, kind="stable")
    s, inverse = np.unique(score[order], return_inverse=True)
    total, weight = np.bincount(inverse, weights=y[order]), np.bincount(inverse).astype(float)
    blocks: list[list[float]] = []  # mean, weight, first, last
    for i in range(len(s)):
        blocks.append([total[i] / weight[i], weight[i], s[i], s[i]])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, _, last = blocks.pop()
            n = blocks[-1]
            n[0], n[1], n[3] = (n[0] * n[1] + m * w) / (n[1] + w), n[1] + w, last
    return np.array([x for b in blocks for x in (b[2], b[3])]), np.array([x for b in blocks for x in (b[0], b[0])])
