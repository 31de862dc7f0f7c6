"""Histogram gradient-boosted trees in numpy, stored as flat arrays.

Friedman's gradient boosting with logistic loss over quantile-binned features.
Trees grow level by level; a node's split comes from histograms of gradients
and hessians. The fitted trees are five arrays of shape (trees, nodes); rows
are scored by moving an index array down all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    n_trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    l2: float = 1.0
    min_leaf: int = 5
    base: float = 0.0
    feature: np.ndarray = field(default=None, repr=False)
    cut: np.ndarray = field(default=None, repr=False)
    value: np.ndarray = field(default=None, repr=False)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        """x: (rows, features), NaN counts as larger than any number; y: 0/1.

        No rows, or a single class, give a constant score.
        """
        x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
        n, width = x.shape
        nodes = 2 ** (self.depth + 1) - 1
        shape = (self.n_trees, nodes)
        # feature -1 marks a leaf; node i has children 2i+1 and 2i+2
        self.feature, self.cut = np.full(shape, -1, np.int32), np.full(shape, np.inf)
        self.value = np.zeros(shape)
        rate = (y.sum() + 0.5) / (n + 1.0)
        self.base = float(np.log(rate / (1 - rate)))
        if n == 0 or y.min() == y.max():
            return self
        edges, codes = [], np.empty((n, width), dtype=np.int64)
        for j in range(width):
            col = x[~np.isnan(x[:, j]), j]
            cuts = np.unique(np.quantile(col, np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) if len(col) else np.empty(0)
            edges.append(cuts)
            codes[:, j] = np.searchsorted(cuts, x[:, j], side="left")
            codes[np.isnan(x[:, j]), j] = len(cuts)
        stride = self.bins + 1
        margin = np.full(n, self.base)
        for t in range(self.n_trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
            self._grow(t, codes, edges, grad, hess, stride)
            margin += self._walk(x, t)
        return self

    def _grow(self, t, codes, edges, grad, hess, stride) -> None:
        n, width = codes.shape
        at = np.zeros(n, dtype=np.int64)
        offsets = np.arange(width) * stride
        for level in range(self.depth + 1):
            first, count = 2**level - 1, 2**level
            for node in range(first, first + count):
                rows = np.flatnonzero(at == node)
                if not len(rows):
                    continue
                g, h = grad[rows], hess[rows]
                total_g, total_h = g.sum(), h.sum()
                self.value[t, node] = -self.rate * total_g / (total_h + self.l2)
                if level == self.depth or len(rows) < 2 * self.min_leaf:
                    continue
                flat = (codes[rows] + offsets).ravel()
                size = width * stride
                hist = [np.bincount(flat, np.repeat(v, width), size).reshape(width, stride).cumsum(1) for v in (g, h, np.ones(len(rows)))]
                left_g, left_h, left_n = (a[:, :-1] for a in hist)
                gain = left_g**2 / (left_h + self.l2) + (total_g - left_g) ** 2 / (total_h - left_h + self.l2) - total_g**2 / (total_h + self.l2)
                gain[(left_n < self.min_leaf) | (len(rows) - left_n < self.min_leaf)] = -np.inf
                for j, cuts in enumerate(edges):
                    gain[j, len(cuts) :] = -np.inf
                best = int(gain.argmax())
                j, b = divmod(best, stride - 1)
                if not gain[j, b] > 1e-7:
                    continue
                self.feature[t, node], self.cut[t, node] = j, edges[j][b]
                at[rows] = 2 * node + 1 + (codes[rows, j] > b)

    def _walk(self, x: np.ndarray, t: int) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[t, at]
            with np.errstate(invalid="ignore"):
                right = ~(x[rows, f] <= self.cut[t, at])
            at = np.where(f < 0, at, 2 * at + 1 + right)
        return self.value[t, at]

    def margin(self, x: np.ndarray, chunk: int = 16384) -> np.ndarray:
        """Log-odds of each row, all trees traversed together."""
        x = np.asarray(x, dtype=np.float64)
        out = np.empty(len(x))
        nodes = self.feature.shape[1]
        roots = (np.arange(self.n_trees) * nodes)[None, :]
        feature, cut, value = self.feature.ravel(), self.cut.ravel(), self.value.ravel()
        for start in range(0, len(x), chunk):
            part = x[start : start + chunk]
            at = np.zeros((len(part), self.n_trees), dtype=np.int64)
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                f = feature[roots + at]
                with np.errstate(invalid="ignore"):
                    right = ~(part[rows, f] <= cut[roots + at])
                at = np.where(f < 0, at, 2 * at + 1 + right)
            out[start : start + chunk] = self.base + value[roots + at].sum(1)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))
