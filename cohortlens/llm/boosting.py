"""Histogram boosting on binned features: additive tables with pairs, and trees.

Both fitters work on a bounded sample in memory; what they make scores any number of
rows by array look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32
PAIR_BINS = 8
RATE = 0.15
ROUNDS = 80
PAIR_ROUNDS = 40
PAIRS = 6
RIDGE = 1.0  # added to every leaf's sum of hessians


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def bin_edges(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Per feature, the values between bins: quantiles, without repeats."""
    if not len(x):
        return [np.zeros(0) for _ in range(x.shape[1])]
    cuts = np.quantile(x, np.arange(1, bins) / bins, axis=0)
    return [np.unique(cuts[:, j]) for j in range(x.shape[1])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack(
        [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1
    ).astype(np.int16)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram in two."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def _shallow_steps(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A depth-two tree over one feature's bins, as a value per bin."""
    parts = [(0, len(g))]
    for _ in range(2):
        new = []
        for low, high in parts:
            gain, at = _best_cut(g[low:high], h[low:high])
            new += [(low, low + at), (low + at, high)] if gain > 1e-9 else [(low, high)]
        parts = new
    out = np.zeros(len(g))
    for low, high in parts:
        out[low:high] = -g[low:high].sum() / (h[low:high].sum() + RIDGE)
    return out


def _shallow_grid(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A depth-two tree over two features' bins: one cut by the first, one by the second."""
    best, values = 0.0, np.zeros_like(g)
    whole = float(_gain(g.sum(), h.sum()))
    for cut in range(1, g.shape[0]):
        total, made = -whole, np.zeros_like(g)
        for rows in (slice(0, cut), slice(cut, None)):
            gr, hr = g[rows].sum(0), h[rows].sum(0)
            gain, at = _best_cut(gr, hr)
            total += gain + float(_gain(gr.sum(), hr.sum()))
            for columns in (slice(0, at), slice(at, None)):
                if len(gr[columns]):
                    made[rows, columns] = -gr[columns].sum() / (hr[columns].sum() + RIDGE)
        if total > best:
            best, values = total, made
    return best, values


@dataclass
class AdditiveModel:
    """Intercept, one table of values per feature, and grids for some pairs of features."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    grids: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        fine, coarse = binned(x, self.edges), binned(x, self.pair_edges)
        total = np.full(len(x), self.intercept)
        for j, table in enumerate(self.tables):
            total += table[fine[:, j]]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[coarse[:, i], coarse[:, j]]
        return sigmoid(total)


def fit_additive(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Boost shallow trees on each feature in turn, then on the pairs that gain most."""
    mean = (y.sum() + 1) / (len(y) + 2)
    edges, pair_edges = bin_edges(x), bin_edges(x, PAIR_BINS)
    fine, coarse = binned(x, edges), binned(x, pair_edges)
    n = x.shape[1]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), np.log(mean / (1 - mean)))
    model = AdditiveModel(float(np.log(mean / (1 - mean))), edges, tables, pair_edges, [], [])
    if not 0 < y.sum() < len(y):
        return model
    for _ in range(ROUNDS):
        for j in range(n):
            p = sigmoid(total)
            g = np.bincount(fine[:, j], p - y, len(tables[j]))
            h = np.bincount(fine[:, j], p * (1 - p), len(tables[j]))
            step = RATE * _shallow_steps(g, h)
            tables[j] += step
            total += step[fine[:, j]]
    sizes = [len(e) + 1 for e in pair_edges]

    def grid(i: int, j: int) -> tuple[float, np.ndarray]:
        p = sigmoid(total)
        at = coarse[:, i] * sizes[j] + coarse[:, j].astype(np.int64)
        shape = (sizes[i], sizes[j])
        g = np.bincount(at, p - y, sizes[i] * sizes[j]).reshape(shape)
        h = np.bincount(at, p * (1 - p), sizes[i] * sizes[j]).reshape(shape)
        return _shallow_grid(g, h)

    gains = {(i, j): grid(i, j)[0] for i in range(n) for j in range(i + 1, n)}
    model.pairs = sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]
    model.grids = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(model.pairs):
            step = RATE * grid(i, j)[1]
            model.grids[k] += step
            total += step[coarse[:, i], coarse[:, j]]
    return model


@dataclass
class Trees:
    """Boosted trees of equal depth: per inner node a feature and a bin, per leaf a value."""

    intercept: float
    edges: list[np.ndarray]
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = binned(x, self.edges)
        total = np.full(len(x), self.intercept)
        rows = np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            while_depth = int(np.log2(len(leaves)))
            for _ in range(while_depth):
                node = 2 * node + 1 + (bins[rows, features[node]] >= cuts[node])
            total += leaves[node - (len(leaves) - 1)]
        return sigmoid(total)


def fit_trees(x: np.ndarray, y: np.ndarray, depth: int = 3, rounds: int = 60) -> Trees:
    """Gradient-boosted trees on logistic loss, split by histograms of bins."""
    mean = (y.sum() + 1) / (len(y) + 2)
    edges = bin_edges(x)
    bins = binned(x, edges)
    total = np.full(len(y), np.log(mean / (1 - mean)))
    inner, n = 2**depth - 1, x.shape[1]
    all_features, all_cuts, all_leaves = [], [], []
    for _ in range(rounds if 0 < y.sum() < len(y) else 0):
        p = sigmoid(total)
        grad, hess = p - y, p * (1 - p)
        features, cuts = np.zeros(inner, np.int64), np.full(inner, BINS + 1, np.int64)
        node = np.zeros(len(y), np.int64)
        for at in range(inner):
            own = node == at
            best = 1e-9
            for j in range(n):
                g = np.bincount(bins[own, j], grad[own], len(edges[j]) + 1)
                h = np.bincount(bins[own, j], hess[own], len(edges[j]) + 1)
                gain, cut = _best_cut(g, h)
                if gain > best:
                    best, features[at], cuts[at] = gain, j, cut
            right = bins[own, features[at]] >= cuts[at]
            node[own] = 2 * at + 1 + right
        leaf = node - inner
        g, h = np.bincount(leaf, grad, inner + 1), np.bincount(leaf, hess, inner + 1)
        values = -RATE * g / (h + RIDGE)
        total += values[leaf]
        all_features.append(features)
        all_cuts.append(cuts)
        all_leaves.append(values)
    shape = (len(all_leaves), inner)
    return Trees(
        float(np.log(mean / (1 - mean))),
        edges,
        np.array(all_features, np.int64).reshape(shape),
        np.array(all_cuts, np.int64).reshape(shape),
        np.array(all_leaves).reshape(len(all_leaves), inner + 1),
    )
