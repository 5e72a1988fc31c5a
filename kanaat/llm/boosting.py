"""Gradient-boosted trees for two classes, as flat arrays, with monotonic features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees: node k has children 2k + 1 (value at most the threshold) and 2k + 2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray  # trees x leaves
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row: all rows go down a level at once."""
        rows, total = np.arange(len(x)), np.full(len(x), self.start)
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner] if len(node) else 0
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Up to ``bins`` - 1 thresholds per feature, midway between values that occur."""
    cuts = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="nearest"))
        cuts.append((values[1:] + values[:-1]) / 2)
    return cuts


def fit(x: np.ndarray, y: np.ndarray, signs: list[int], rounds: int = 60, depth: int = 3, rate: float = 0.2,
        bins: int = 64, ridge: float = 1.0, least_weight: float = 2.0) -> Trees:
    """Trees on the log loss. A split on a signed feature is taken only if its sides' values are in that order, and
    bounds both sides at their middle, so that no deeper split can turn the order round. Without both classes the
    model is a constant."""
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    inner = 2 ** depth - 1
    trees = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    if len(np.unique(y)) < 2:
        return trees
    cuts = cut_points(x, bins)
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
    total, made = np.full(len(y), start), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        feature, threshold, value = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
        node = np.zeros(len(y), np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for k in range(inner):
            here = np.flatnonzero(node == k)
            low, high = bounds[k]
            best = best_split(binned[here], p[here] - y[here], (p * (1 - p))[here], cuts, signs, low, high, ridge, least_weight)
            bounds[2 * k + 1] = bounds[2 * k + 2] = (low, high)
            if best is not None:
                _, f, cut, left, right = best
                feature[k], threshold[k] = f, cuts[f][cut]
                middle = (left + right) / 2
                if signs[f]:
                    below, above = (low, middle), (middle, high)
                    bounds[2 * k + 1], bounds[2 * k + 2] = (below, above) if signs[f] > 0 else (above, below)
            node[here] = 2 * k + 1 + (binned[here, feature[k]] > best[2] if best is not None else 0)
        for leaf in range(inner + 1):
            here = node == inner + leaf
            low, high = bounds[inner + leaf]
            weight = -(p[here] - y[here]).sum() / ((p * (1 - p))[here].sum() + ridge)
            value[leaf] = rate * np.clip(weight, low, high)
        total += value[node - inner]
        made.append((feature, threshold, value))
    trees.feature, trees.threshold, trees.value = (np.stack(a) for a in zip(*made, strict=True))
    return trees


def best_split(binned, gradient, curvature, cuts, signs, low, high, ridge, least_weight):
    """(gain, feature, cut, left value, right value) of the best allowed split, or None."""
    best = None
    g, h = gradient.sum(), curvature.sum()
    if len(gradient) < 2:
        return None

    def score(g_, h_):
        v = np.clip(-g_ / (h_ + ridge), low, high)
        return v, -(g_ * v + 0.5 * (h_ + ridge) * v * v)

    _, whole = score(g, h)
    for f, cut in enumerate(cuts):
        if not len(cut):
            continue
        gl = np.cumsum(np.bincount(binned[:, f], gradient, len(cut) + 1))[:-1]
        hl = np.cumsum(np.bincount(binned[:, f], curvature, len(cut) + 1))[:-1]
        (left, a), (right, b) = score(gl, hl), score(g - gl, h - hl)
        gain = a + b - whole
        gain[(hl < least_weight) | (h - hl < least_weight) | (signs[f] * (right - left) < 0)] = -np.inf
        at = int(np.argmax(gain))
        if gain[at] > 1e-6 and (best is None or gain[at] > best[0]):
            best = (gain[at], f, at, left[at], right[at])
    return best
