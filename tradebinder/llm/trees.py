"""Gradient-boosted trees over histograms, held as flat arrays.

Features are cut into bins once; a split is then found from per-bin sums of gradients and
Hessians of the logistic loss.  All trees share five arrays, so that scoring moves a whole
matrix of (row, tree) cursors one level down per step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """feature is -1 at leaves; a row goes left where its value is <= threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    depth: int

    def raw(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(rows), self.base)
        at = np.repeat(self.roots[None, :], len(rows), axis=0)
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            f = self.feature[at]
            down = np.where(rows[row, np.maximum(f, 0)] <= self.threshold[at], self.left[at], self.right[at])
            at = np.where(f >= 0, down, at)
        return self.base + self.value[at].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(rows))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def bin_edges(rows: np.ndarray, bins: int) -> list[np.ndarray]:
    """Upper bin limits per feature: quantiles of the rows, each once."""
    cuts = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(rows[:, k], cuts, method="lower")) for k in range(rows.shape[1])]


def fit_forest(
    rows: np.ndarray,
    label: np.ndarray,
    weight: np.ndarray | None = None,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least_weight: float = 5.0,
    ridge: float = 1.0,
) -> Forest:
    """Boost ``trees`` trees on the logistic loss.

    Without rows the forest is a constant of one half; with one label only, a constant near it.
    """
    n = len(rows)
    weight = np.ones(n) if weight is None else weight.astype(float)
    positive, total = float((weight * label).sum()), float(weight.sum())
    base = float(np.log((positive + 0.5) / (total - positive + 0.5)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < positive < total:
        edges = bin_edges(rows, bins)
        binned = np.stack([np.searchsorted(e, rows[:, k], side="left") for k, e in enumerate(edges)], axis=1)
        score = np.full(n, base)

        def node() -> int:
            for part, empty in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0), (value, 0.0)):
                part.append(empty)
            return len(feature) - 1

        def grow(at: int, own: np.ndarray, grad: np.ndarray, hess: np.ndarray, levels: int) -> None:
            g, h = grad[own].sum(), hess[own].sum()
            best = (1e-6, -1, 0)
            if levels:
                for k, e in enumerate(edges):
                    if not len(e):
                        continue
                    size = len(e) + 1
                    b = binned[own, k]
                    gl = np.cumsum(np.bincount(b, grad[own], size))[:-1]
                    hl = np.cumsum(np.bincount(b, hess[own], size))[:-1]
                    wl = np.cumsum(np.bincount(b, weight[own], size))
                    ok = (wl[:-1] >= least_weight) & (wl[-1] - wl[:-1] >= least_weight)
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    gain = np.where(ok, gain, 0)
                    cut = int(gain.argmax())
                    if gain[cut] > best[0]:
                        best = (gain[cut], k, cut)
            if best[1] < 0:
                value[at] = -rate * g / (h + ridge)
                score[own] += value[at]
                return
            _, k, cut = best
            feature[at], threshold[at] = k, float(edges[k][cut])
            goes_left = binned[own, k] <= cut
            left[at] = node()
            right[at] = node()
            grow(left[at], own[goes_left], grad, hess, levels - 1)
            grow(right[at], own[~goes_left], grad, hess, levels - 1)

        for _ in range(trees):
            p = sigmoid(score)
            root = node()
            roots.append(root)
            grow(root, np.arange(n), weight * (p - label), np.maximum(weight * p * (1 - p), 1e-9), depth)
    as_int = lambda x: np.array(x, dtype=np.int32)
    return Forest(
        as_int(feature), np.array(threshold), as_int(left), as_int(right), np.array(value), as_int(roots), base, depth
    )
