"""Histogram gradient-boosted trees, kept as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: node k's children are 2k + 1 and 2k + 2.

    ``feature`` and ``threshold`` have a row a tree and a column an inner node,
    ``leaf`` a column a leaf; ``start`` is the logit before any tree.
    """

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row; all rows go down a level at once."""
        logit = np.full(len(x), self.start)
        inner, rows = self.feature.shape[1], np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(x) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            logit += leaf[node - inner]
        return 1 / (1 + np.exp(-logit))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, ridge: float = 1.0
) -> Trees:
    """Trees for labels ``y`` (0 or 1); without rows, a model that says 0.5."""
    inner = 2**depth - 1
    if not len(x):
        none = np.zeros((0, inner))
        return Trees(0.0, none.astype(np.int64), none, np.zeros((0, inner + 1)))
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(prior / (1 - prior)))
    logit = np.full(n, start)
    features, thresholds, leaves = [], [], []
    column = np.arange(m) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (m * bins) + column + binned).ravel()
            size = width * m * bins
            sums = [
                np.bincount(at, np.repeat(v, m), size).reshape(width, m, bins).cumsum(axis=2) for v in (g, h)
            ]
            (gl, hl), (gt, ht) = sums, (s[:, :1, -1:] for s in sums)
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            for j, c in enumerate(cuts):
                gain[:, j, len(c) :] = -1  # nothing lies beyond the last cut
            best = gain.reshape(width, -1).argmax(axis=1)
            for k, b in enumerate(best):
                j, cut = divmod(int(b), bins)
                if gain[k, j, cut] > 1e-6:
                    feature[first + k], threshold[first + k] = j, cuts[j][cut]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf_of = node - inner
        leaf = -rate * np.bincount(leaf_of, g, inner + 1) / (np.bincount(leaf_of, h, inner + 1) + ridge)
        logit += leaf[leaf_of]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(start, np.array(features), np.array(thresholds), np.array(leaves))
