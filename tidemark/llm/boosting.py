"""Gradient-boosted trees for a few classes, in numpy."""

from __future__ import annotations

import numpy as np

_BINS = 32


class BoostedTrees:
    """Softmax boosting with complete trees over binned features; a fixed seed makes fits repeatable."""

    def __init__(self, classes: int, rounds: int = 30, depth: int = 4, rate: float = 0.3, rows: float = 0.5, columns: float = 0.3, seed: int = 0) -> None:
        self.classes, self.rounds, self.depth, self.rate, self.seed = classes, rounds, depth, rate, seed
        self.rows, self.columns = rows, columns  # the share of both that a tree is grown on

    def fit(self, x: np.ndarray, y: np.ndarray, l2: float = 2.0) -> BoostedTrees:
        rng = np.random.default_rng(self.seed)
        self.prior = np.log(np.bincount(y, minlength=self.classes) + 1.0)
        quantiles = np.linspace(0, 1, _BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(column, quantiles)) for column in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T)], axis=1)
        score = np.tile(self.prior, (len(x), 1))
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        for _ in range(self.rounds):
            p = _softmax(score)
            trees = []
            for k in range(self.classes):
                gradient, weight = (y == k) - p[:, k], p[:, k] * (1 - p[:, k])
                used = np.sort(rng.choice(x.shape[1], max(1, int(self.columns * x.shape[1])), replace=False))
                some = np.flatnonzero(rng.random(len(x)) < self.rows)
                trees.append(self._grow(binned[np.ix_(some, used)], used, gradient[some], weight[some], l2))
            for k, tree in enumerate(trees):
                score[:, k] += self._value(x, tree)
            self.trees.append(trees)
        return self

    def _grow(self, binned: np.ndarray, used: np.ndarray, gradient: np.ndarray, weight: np.ndarray, l2: float):
        n, columns = binned.shape
        feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
        at = np.zeros(n, np.int64)  # place within the level
        cells = np.arange(columns) * _BINS + binned
        for level in range(self.depth):
            wide = 2**level
            cell = (at[:, None] * (columns * _BINS) + cells).ravel()
            shape = (wide, columns, _BINS)
            g, h = (np.bincount(cell, np.repeat(v, columns), np.prod(shape)).reshape(shape).cumsum(axis=2) for v in (gradient, weight))
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + l2) + (all_g - g) ** 2 / (all_h - h + l2) - all_g**2 / (all_h + l2)
            best = gain.reshape(wide, -1).argmax(axis=1)
            split, bin_ = best // _BINS, best % _BINS
            nodes = wide - 1 + np.arange(wide)
            feature[nodes] = used[split]
            # a value goes right if it lies above the edge; the last bin has no edge and sends all left
            cut[nodes] = [self.edges[f][b] if b < len(self.edges[f]) else np.inf for f, b in zip(feature[nodes], bin_)]
            at = 2 * at + (binned[np.arange(n), split[at]] > bin_[at])
        g, h = (np.bincount(at, v, 2**self.depth) for v in (gradient, weight))
        return feature, cut, self.rate * g / (h + l2)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.tile(self.prior, (len(x), 1))
        for trees in self.trees:
            for k, tree in enumerate(trees):
                score[:, k] += self._value(x, tree)
        return score

    def _value(self, x: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        feature, cut, value = tree
        node, row = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[row, feature[node]] > cut[node])
        return value[node - len(feature)]

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        return np.log(_softmax(self.log_odds(x)) + 1e-12)


def _softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)
