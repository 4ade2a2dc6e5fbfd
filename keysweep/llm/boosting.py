"""Gradient-boosted trees for two classes, as flat numpy arrays: histogram training, vectorised scoring.

Features with a monotonic constraint (1: the score never falls as the feature grows, -1: it never rises) only get
splits whose sides are in that order, and both sides keep to the middle between them further down.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees one after the other; a leaf has itself as both children."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``. NaN goes to the left."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                right = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(right, self.right[node], self.left[node])
            total += self.value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.score(x), -50, 50)))


def cut_points(column: np.ndarray, bins: int) -> np.ndarray:
    known = np.unique(column[np.isfinite(column)])
    if len(known) <= 1:
        return np.empty(0)
    middles = (known[1:] + known[:-1]) / 2
    if len(middles) < bins:
        return middles
    return np.unique(np.quantile(column[np.isfinite(column)], np.arange(1, bins) / bins))


def train(
    x: np.ndarray,
    y: np.ndarray,
    monotone: Sequence[int] | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    least: int = 8,
    ridge: float = 1.0,
    bins: int = BINS,
) -> Trees:
    """Trees for rows ``x`` with classes ``y`` (0 or 1); without rows, or with one class, a constant."""
    monotone = np.zeros(x.shape[1], int) if monotone is None else np.asarray(monotone)
    share = np.clip((y.sum() + 0.5) / (len(y) + 1), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        cuts = [cut_points(x[:, j], bins) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            grow = Grower(binned, cuts, y - p, p * (1 - p), monotone, depth, rate, least, ridge, nodes)
            roots.append(grow.node(np.arange(len(y)), 0, -np.inf, np.inf))
            score += grow.fitted
    return Trees(
        base,
        np.array(roots, np.int64),
        np.array(nodes["feature"], np.int64),
        np.array(nodes["threshold"], float),
        np.array(nodes["left"], np.int64),
        np.array(nodes["right"], np.int64),
        np.array(nodes["value"], float),
        depth,
    )


class Grower:
    """Grows one tree on gradients ``g`` and second derivatives ``h``, and appends its nodes to ``nodes``."""

    def __init__(self, binned, cuts, g, h, monotone, depth, rate, least, ridge, nodes):
        self.binned, self.cuts, self.g, self.h = binned, cuts, g, h
        self.monotone, self.depth, self.rate, self.least, self.ridge, self.nodes = monotone, depth, rate, least, ridge, nodes
        self.fitted = np.zeros(len(g))

    def node(self, rows: np.ndarray, level: int, low: float, high: float) -> int:
        at = len(self.nodes["value"])
        for name, value in (("feature", 0), ("threshold", np.inf), ("left", at), ("right", at), ("value", 0.0)):
            self.nodes[name].append(value)
        found = self.split(rows, low, high) if level < self.depth else None
        if found is None:
            value = float(np.clip(self.g[rows].sum() / (self.h[rows].sum() + self.ridge), low, high)) * self.rate
            self.nodes["value"][at] = value
            self.fitted[rows] = value
            return at
        feature, bin_, left_value, right_value = found
        goes_right = self.binned[rows, feature] > bin_
        middle = (left_value + right_value) / 2
        left_range, right_range = (low, high), (low, high)
        if self.monotone[feature] > 0:
            left_range, right_range = (low, middle), (middle, high)
        elif self.monotone[feature] < 0:
            left_range, right_range = (middle, high), (low, middle)
        self.nodes["feature"][at] = feature
        self.nodes["threshold"][at] = float(self.cuts[feature][bin_])
        self.nodes["left"][at] = self.node(rows[~goes_right], level + 1, *left_range)
        self.nodes["right"][at] = self.node(rows[goes_right], level + 1, *right_range)
        return at

    def split(self, rows: np.ndarray, low: float, high: float):
        """Feature, bin and values of the sides of the best split, if one is better than none."""
        g, h = self.g[rows], self.h[rows]
        all_g, all_h, count = g.sum(), h.sum(), len(rows)
        gain_of = lambda a, b, v: 2 * a * v - (b + self.ridge) * v * v
        whole = np.clip(all_g / (all_h + self.ridge), low, high)
        best, found = gain_of(all_g, all_h, whole) + 1e-9, None
        for j, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            bins, size = self.binned[rows, j], len(cuts) + 1
            left_n = np.cumsum(np.bincount(bins, minlength=size))[:-1]
            left_g = np.cumsum(np.bincount(bins, g, size))[:-1]
            left_h = np.cumsum(np.bincount(bins, h, size))[:-1]
            left = np.clip(left_g / (left_h + self.ridge), low, high)
            right = np.clip((all_g - left_g) / (all_h - left_h + self.ridge), low, high)
            gain = gain_of(left_g, left_h, left) + gain_of(all_g - left_g, all_h - left_h, right)
            bad = (left_n < self.least) | (count - left_n < self.least) | (self.monotone[j] * (right - left) < 0)
            gain[bad] = -np.inf
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, found = gain[k], (j, k, float(left[k]), float(right[k]))
        return found
