"""Gradient-boosted trees on few dense features, and isotonic calibration.

Both are fitted on the driver, on a sample whose size a parameter bounds.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS = 80, 3, 0.15, 32
RIDGE, LEAST_CHILD = 1.0, 3.0


@dataclass
class Trees:
    """Complete binary trees: node i of a level has children 2i and 2i + 1 of the next."""

    feature: np.ndarray  # trees x inner nodes, in level order
    above: np.ndarray  # go right where the value is greater
    leaf: np.ndarray  # trees x leaves
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, above, leaf in zip(self.feature, self.above, self.leaf):
            node = np.zeros(len(x), np.int64)
            for level in range(DEPTH):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, feature[at]] > above[at])
            out += leaf[node]
        return out


def _edges(column: np.ndarray) -> np.ndarray:
    """Cuts between distinct values, at most ``BINS`` - 1 of them; zeros count once, as
    most features are zero in most rows."""
    values = np.unique(column)
    if len(values) > BINS:
        rest = column[column != 0]
        values = np.unique(np.r_[column.min(), 0.0, np.quantile(rest, np.linspace(0, 1, BINS - 2))])
    return (values[:-1] + values[1:]) / 2


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Logistic loss, second-order gains over histograms."""
    rows, width = x.shape
    edges = [_edges(x[:, j]) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    share = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    margin, inner = np.full(rows, base), (1 << DEPTH) - 1
    features, cuts, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-9)
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(rows, np.int64)
        for level in range(DEPTH):
            nodes = 1 << level
            best = np.full(nodes, 1e-9)
            for j in range(width):
                if not len(edges[j]):
                    continue
                key, size = node * BINS + binned[:, j], nodes * BINS
                gs = np.bincount(key, g, size).reshape(nodes, BINS).cumsum(axis=1)
                hs = np.bincount(key, h, size).reshape(nodes, BINS).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (gt - gl) ** 2 / (ht - hl + RIDGE) - gt**2 / (ht + RIDGE)
                gain[(hl < LEAST_CHILD / 4) | (ht - hl < LEAST_CHILD / 4)] = 0
                gain[:, len(edges[j]) :] = 0
                at = gain.argmax(axis=1)
                found = gain[np.arange(nodes), at]
                for i in np.flatnonzero(found > best):
                    best[i], where = found[i], nodes - 1 + i
                    feature[where], cut[where] = j, edges[j][at[i]]
            at = nodes - 1 + node
            node = 2 * node + (x[np.arange(rows), feature[at]] > cut[at])
        size = 1 << DEPTH
        value = -RATE * np.bincount(node, g, size) / (np.bincount(node, h, size) + RIDGE)
        margin += value[node]
        features.append(feature), cuts.append(cut), leaves.append(value)
    return Trees(np.array(features), np.array(cuts), np.array(leaves), base)


@dataclass
class Isotonic:
    """A rising curve from margins to probabilities, straight between its points."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, margins: np.ndarray) -> np.ndarray:
        return np.interp(margins, self.at, self.value)


def fit_isotonic(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Isotonic:
    """Pool adjacent violators; each pool stands at its mean margin.

    Beyond the outermost pools the curve goes on towards 0 and 1, so that scores differ
    there as well.
    """
    pools: list[list[float]] = []  # weighted labels, weight, weighted margins
    for i in np.argsort(margins, kind="stable"):
        pools.append([y[i] * weight[i], weight[i], margins[i] * weight[i]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    at = np.array([p[2] / p[1] for p in pools])
    value = np.array([p[0] / p[1] for p in pools])
    at = np.r_[min(at[0], margins.min()) - 5, at, max(at[-1], margins.max()) + 5]
    value = np.r_[0.0, 0.001 + 0.998 * value, 1.0]
    return Isotonic(at, value)
