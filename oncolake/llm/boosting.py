"""Histogram gradient-boosted trees for two classes, small enough to fit on the driver.

Callers bound the number of rows or cells they fit on. A fitted model is a few flat arrays, which
score numpy tables by a vectorised walk (``predict``) or become column expressions (``as_column``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Trees:
    """All trees of a model in arrays of shape (trees, nodes); nodes 2i+1 and 2i+2 follow node i.

    A node sends a row left when its feature is at most the threshold. ``feature`` is -1 in leaves.
    """

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, table: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        total = np.full(len(table), self.base)
        rows = np.arange(len(table))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(table), np.int64)
            for _ in range(self.depth):
                split = feature[node]
                right = table[rows, np.maximum(split, 0)] > threshold[node]
                node = np.where(split >= 0, 2 * node + 1 + right, node)
            total += value[node]
        return total

    def predict(self, table: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        return 1 / (1 + np.exp(-np.clip(self.margin(table), -40, 40)))

    def as_column(self, columns: list[Column]) -> Column:
        """The probability as an expression of built-in functions."""

        def branch(tree: int, node: int) -> Column:
            split = int(self.feature[tree, node])
            if split < 0:
                return F.lit(float(self.value[tree, node]))
            test = columns[split] <= F.lit(float(self.threshold[tree, node]))
            return F.when(test, branch(tree, 2 * node + 1)).otherwise(branch(tree, 2 * node + 2))

        total = F.lit(float(self.base))
        for tree in range(len(self.feature)):
            total = total + branch(tree, 0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(
    table: np.ndarray,
    target: np.ndarray,
    weight: np.ndarray | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 32,
    least: float = 5.0,
    ridge: float = 1.0,
) -> Trees:
    """Fit trees to 0/1 targets by Newton steps on weighted histograms.

    The result depends on the rows and their weights, not on their order. Without rows the model
    answers one half; with one class only it answers the smoothed share of that class.
    """
    table, target = np.asarray(table, float), np.asarray(target, float)
    weight = np.ones(len(target)) if weight is None else np.asarray(weight, float)
    nodes = 2 ** (depth + 1) - 1
    positive, total = float((weight * target).sum()), float(weight.sum())
    share = (positive + 0.5) / (total + 1)
    base = float(np.log(share / (1 - share)))
    shape = (trees, nodes)
    model = Trees(base, np.full(shape, -1), np.zeros(shape), np.zeros(shape), depth)
    if not len(target) or positive in (0.0, total):
        return Trees(base, model.feature[:0], model.threshold[:0], model.value[:0], depth)
    order = np.lexsort([target, *table.T[::-1]])
    table, target, weight = table[order], target[order], weight[order]
    cuts = [_cuts(column, weight, bins) for column in table.T]
    codes = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, table.T)])
    width, features = bins + 1, len(cuts)
    margin = np.full(len(target), base)
    for tree in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = weight * (target - chance), weight * chance * (1 - chance)
        node = np.zeros(len(target), np.int64)
        for level in range(depth + 1):
            first, count = 2**level - 1, 2**level
            here = np.flatnonzero(node >= first)
            local = node[here] - first
            g = np.bincount(local, slope[here], count)
            h = np.bincount(local, bend[here], count)
            model.value[tree, first : first + count] = rate * g / (h + ridge)
            if level == depth or not len(here):
                break
            gains = np.full((count, features, width), -np.inf)
            for f in range(features):
                cell = local * width + codes[f, here]
                gl = np.bincount(cell, slope[here], count * width).reshape(count, width).cumsum(1)
                hl = np.bincount(cell, bend[here], count * width).reshape(count, width).cumsum(1)
                wl = np.bincount(cell, weight[here], count * width).reshape(count, width).cumsum(1)
                gr, hr, wr = g[:, None] - gl, h[:, None] - hl, wl[:, -1:] - wl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (g**2 / (h + ridge))[:, None]
                gain[(wl < least) | (wr < least)] = -np.inf
                gain[:, len(cuts[f]) :] = -np.inf
                gains[:, f] = gain
            for n in range(count):
                f, cut = divmod(int(gains[n].argmax()), width)
                if gains[n, f, cut] <= 1e-6:
                    continue
                model.feature[tree, first + n], model.threshold[tree, first + n] = f, cuts[f][cut]
                rows = here[local == n]
                node[rows] = 2 * (first + n) + 1 + (codes[f, rows] > cut)
        margin += model.value[tree, node]
    return model


def _cuts(column: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between values: all of a small set, weighted quantiles of a large one."""
    values, inverse = np.unique(column, return_inverse=True)
    if len(values) > bins:
        sums = np.bincount(inverse, weight).cumsum()
        picks = np.searchsorted(sums, np.linspace(0, sums[-1], bins + 1)[1:-1])
        low = np.unique(np.minimum(picks, len(values) - 2))
    else:
        low = np.arange(len(values) - 1)
    return (values[low] + values[low + 1]) / 2
