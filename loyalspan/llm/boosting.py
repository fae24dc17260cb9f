"""Gradient-boosted trees for a yes/no label, and isotonic calibration, on small feature tables."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """Nodes in arrays; a leaf has feature -1. Rows with ``x <= threshold`` go left."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self) -> int:
        for name, start in (("feature", -1), ("threshold", 0.0), ("left", 0), ("right", 0), ("value", 0.0)):
            getattr(self, name).append(start)
        return len(self.feature) - 1

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        feature, threshold = np.array(self.feature), np.array(self.threshold)
        left, right = np.array(self.left), np.array(self.right)
        while True:
            inner = np.nonzero(feature[at] >= 0)[0]
            if not len(inner):
                return np.array(self.value)[at]
            node = at[inner]
            low = x[inner, feature[node]] <= threshold[node]
            at[inner] = np.where(low, left[node], right[node])


@dataclass
class BoostedTrees:
    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    ridge: float = 1.0
    least: int = 5
    start: float = 0.0
    grown: list[Tree] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Newton boosting of the log loss; splits at quantiles of each feature."""
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]
        margin = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            tree = Tree()
            self._grow(tree, tree.add(), np.arange(len(y)), 0, p - y, np.maximum(p * (1 - p), 1e-6), edges, binned)
            margin = margin + tree.predict(x)
            self.grown.append(tree)
        return self

    def _grow(self, tree, node, rows, level, slope, curve, edges, binned) -> None:
        g, h = slope[rows].sum(), curve[rows].sum()
        tree.value[node] = float(-self.rate * g / (h + self.ridge))
        best = (1e-6, None, None)
        if level < self.depth and len(rows) >= 2 * self.least:
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                size = len(cuts) + 1
                of = binned[f][rows]
                gl = np.cumsum(np.bincount(of, slope[rows], size))[:-1]
                hl = np.cumsum(np.bincount(of, curve[rows], size))[:-1]
                nl = np.cumsum(np.bincount(of, minlength=size))[:-1]
                gain = gl**2 / (hl + self.ridge) + (g - gl) ** 2 / (h - hl + self.ridge) - g**2 / (h + self.ridge)
                gain[(nl < self.least) | (len(rows) - nl < self.least)] = 0
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (float(gain[at]), f, at)
        if best[1] is None:
            return
        _, f, at = best
        tree.feature[node], tree.threshold[node] = f, float(edges[f][at])
        low = binned[f][rows] <= at
        for name, part in (("left", rows[low]), ("right", rows[~low])):
            child = tree.add()
            getattr(tree, name)[node] = child
            self._grow(tree, child, part, level + 1, slope, curve, edges, binned)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.predict(x) for t in self.grown), np.zeros(len(x)))


@dataclass
class Isotonic:
    """A rising map of margins to shares: pooled blocks, linear between their centres."""

    at: np.ndarray
    share: np.ndarray

    @classmethod
    def fit(cls, margin: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(margin, kind="stable")
        blocks: list[list[float]] = []  # sum of labels, rows, sum of margins
        for m, label in zip(margin[order], y[order]):
            blocks.append([float(label), 1.0, float(m)])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
        # Half a row of either label in each block keeps shares off 0 and 1.
        share = np.array([(b[0] + 0.5) / (b[1] + 1.0) for b in blocks])
        return cls(np.array([b[2] / b[1] for b in blocks]), np.maximum.accumulate(share))

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        # A last small slope keeps apart what the blocks make equal.
        return np.clip(np.interp(margin, self.at, self.share) + 1e-3 * np.tanh(margin / 10), 0.0, 1.0)
