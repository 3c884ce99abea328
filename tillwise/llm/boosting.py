"""Gradient-boosted trees with a logistic loss, on binned features."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: feature and threshold per inner node, value per leaf."""
    base: float
    features: np.ndarray  # trees x inner nodes
    cuts: np.ndarray
    leaves: np.ndarray  # trees x leaves

    def chance(self, rows: np.ndarray) -> np.ndarray:
        raw = np.full(len(rows), self.base)
        each = np.arange(len(rows))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(rows), np.int64)
            while_inner = len(features)
            for _ in range(while_inner.bit_length()):
                at = 2 * at + 1 + (rows[each, features[at]] > cuts[at])
            raw += leaves[at - while_inner]
        return 1 / (1 + np.exp(-raw))


def fit(rows: np.ndarray, truth: np.ndarray, weight: np.ndarray, trees: int = 50, depth: int = 4,
        rate: float = 0.2, bins: int = 32, least: float = 5.0) -> Trees:
    """Each tree fits the gradient of the loss; a split maximises the gain of second order."""
    grid = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
            for f in range(rows.shape[1])]
    coded = np.stack([np.searchsorted(g, rows[:, f]) for f, g in enumerate(grid)], 1)
    share = np.clip(np.average(truth, weights=weight), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    raw = np.full(len(rows), base)
    inner, size = (1 << depth) - 1, bins + 1
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, curvature = (truth - p) * weight, np.maximum(p * (1 - p), 1e-6) * weight
        at = np.zeros(len(rows), np.int64)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first = (1 << level) - 1
            nodes = 1 << level
            best = np.full(nodes, 1e-9)
            for f, g in enumerate(grid):
                if not len(g):
                    continue
                key = (at - first) * size + coded[:, f]
                sums = np.bincount(key, gradient, nodes * size).reshape(nodes, size).cumsum(1)
                curves = np.bincount(key, curvature, nodes * size).reshape(nodes, size).cumsum(1)
                left, left_c = sums[:, :len(g)], curves[:, :len(g)]
                right, right_c = sums[:, -1:] - left, curves[:, -1:] - left_c
                gain = (left ** 2 / (left_c + 1) + right ** 2 / (right_c + 1)
                        - sums[:, -1:] ** 2 / (curves[:, -1:] + 1))
                gain[(left_c < least / 10) | (right_c < least / 10)] = 0
                top = gain.argmax(1)
                better = gain[np.arange(nodes), top] > best
                best[better] = gain[np.arange(nodes), top][better]
                features[first:first + nodes][better] = f
                cuts[first:first + nodes][better] = g[top[better]]
            at = 2 * at + 1 + (rows[np.arange(len(rows)), features[at]] > cuts[at])
        leaf = at - inner
        total = np.bincount(leaf, gradient, inner + 1)
        leaves = rate * total / (np.bincount(leaf, curvature, inner + 1) + 1)
        raw += leaves[leaf]
        all_features.append(features)
        all_cuts.append(cuts)
        all_leaves.append(leaves)
    return Trees(base, np.array(all_features), np.array(all_cuts), np.array(all_leaves))
