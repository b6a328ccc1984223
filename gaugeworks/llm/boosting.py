"""Histogram gradient-boosted trees for two classes, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Perfect trees, flattened: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; rows above go right
    value: np.ndarray  # trees x leaves
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row; all rows descend a tree together."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def _bin_edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges between bins, at quantiles of the values that occur."""
    found = np.unique(column)
    if len(found) <= bins:
        return (found[:-1] + found[1:]) / 2
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    l2: float = 2.0,
    min_rows: int = 10,
    prior_rows: float = 10.0,
    prior: float = 0.9,
) -> Forest:
    """Fit by logistic loss. Without rows of both classes: the smoothed base rate alone."""
    share = (y.sum() + prior * prior_rows) / (len(y) + prior_rows)
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    if len(y) == 0 or y.min() == y.max():
        return Forest(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    n, width = x.shape
    edges = [_bin_edges(x[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
    flat = binned + np.arange(width) * bins
    total = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)
        node = np.zeros(n, dtype=np.int64)  # within its level
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            where = (node[:, None] * (width * bins) + flat).ravel()
            shape, size = (nodes, width, bins), nodes * width * bins
            sums = [
                np.bincount(where, weights=w, minlength=size).reshape(shape).cumsum(axis=2)
                for w in (np.repeat(g, width), np.repeat(h, width), np.ones(n * width))
            ]
            gl, hl, nl = sums
            gt, ht, nt = gl[:, :, -1:], hl[:, :, -1:], nl[:, :, -1:]
            gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
            gain[(nl < min_rows) | (nt - nl < min_rows)] = 0
            for f in range(width):  # a split needs an edge
                gain[:, f, len(edges[f]) :] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for i in range(nodes):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] > 1e-9:
                    feature[first + i], threshold[first + i] = f, edges[f][b]
            own = first + node
            node = 2 * node + (x[np.arange(n), feature[own]] > threshold[own])
        leaf_g = np.bincount(node, weights=g, minlength=inner + 1)
        leaf_h = np.bincount(node, weights=h, minlength=inner + 1)
        value = rate * leaf_g / (leaf_h + l2)
        total += value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(np.array(features), np.array(thresholds), np.array(values), base)
