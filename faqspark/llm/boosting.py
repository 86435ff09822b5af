"""Gradient-boosted trees for small training sets, fitted with numpy and evaluated on whole arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: ``feature`` and ``cut`` per inner node, ``leaf`` values; all in heap order."""

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - len(feature)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _bins(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Cut points of each feature: midpoints of its values, or quantiles of many."""
    cuts = []
    for column in x.T:
        values = np.unique(column)
        middle = (values[1:] + values[:-1]) / 2
        cuts.append(middle if len(middle) < most else np.unique(np.quantile(column, np.arange(1, most) / most)))
    return cuts


def fit(x: np.ndarray, y: np.ndarray, *, rounds: int = 80, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, most_bins: int = 32) -> Trees:
    """Logistic boosting; every node takes the cut with the largest second-order gain, or none (all rows to the left)."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    cuts = _bins(x, most_bins)
    binned = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T)], axis=1)
    inner, width = 2**depth - 1, most_bins + 1
    margin = np.full(len(y), base)
    features, places, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        slope, curve = y - p, p * (1 - p)
        feature, place, node = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), int)
        goes = np.zeros(len(y), int)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            own = node - first
            best = np.full(count, 1e-6)
            cut_bin = np.full(count, width)
            for f in range(x.shape[1]):
                if not len(cuts[f]):
                    continue
                at = own * width + binned[:, f]
                g = np.bincount(at, slope, count * width).reshape(count, width).cumsum(axis=1)
                h = np.bincount(at, curve, count * width).reshape(count, width).cumsum(axis=1)
                left, right = g**2 / (h + ridge), (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + ridge)
                gain = (left + right - g[:, -1:] ** 2 / (h[:, -1:] + ridge))[:, : len(cuts[f])]
                top = gain.argmax(axis=1)
                better = gain[np.arange(count), top] > best
                best[better] = gain[np.arange(count), top][better]
                cut_bin[better] = top[better]
                feature[first : first + count][better] = f
            for k in range(count):
                if cut_bin[k] < width:
                    place[first + k] = cuts[feature[first + k]][cut_bin[k]]
            goes = binned[np.arange(len(y)), feature[node]] > cut_bin[own]
            node = 2 * node + 1 + goes
        leaf_of = node - inner
        leaf = rate * np.bincount(leaf_of, slope, inner + 1) / (np.bincount(leaf_of, curve, inner + 1) + ridge)
        margin += leaf[leaf_of]
        features.append(feature)
        places.append(place)
        leaves.append(leaf)
    return Trees(base, depth, np.array(features), np.array(places), np.array(leaves))
