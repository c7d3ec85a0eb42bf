"""Small gradient boosting on numeric features, in memory or over the rows of a table.

Trees grow from sums of gradients by node, feature and bin. These are sums of
whole numbers, so neither the order nor the number of tasks changes a tree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 24
# Where a feature's values are cut, as shares of the examples.
QUANTILES = tuple(np.linspace(0, 1, BINS + 1)[1:-1].tolist())
# Gradients are counted in parts of this size.
_PARTS = 1 << 20
# The fewest examples of a node that is divided.
_LEAST = 10


@dataclass(frozen=True)
class Boosted:
    """Complete trees: node ``i`` has children ``2i + 1`` and ``2i + 2``; leaves follow the inner nodes."""

    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            total += leaf[_descend(x, feature, cut, depth)]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def _descend(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The place of each row's node among those of a level."""
    rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
    for _ in range(levels):
        node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
    return node - ((1 << levels) - 1)


def constant(mean: float, depth: int = 3) -> Boosted:
    """No trees: examples of one kind only, or none (0.5)."""
    inner = (1 << depth) - 1
    return Boosted(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), 35.0 * (2 * mean - 1))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The number of a feature's cuts below its value, one byte each."""
    return np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)], 1).astype(np.uint8)


# (trees so far, features and cuts of the tree that grows, its level) to sums of gradient, curvature and examples by
# node, feature and bin.
Histograms = Callable[[Boosted, np.ndarray, np.ndarray, int], np.ndarray]


def _histograms(
    x: np.ndarray, y: np.ndarray, n: np.ndarray, grown: Boosted, feature: np.ndarray, cut: np.ndarray, level: int
) -> np.ndarray:
    """For binned examples that stand for ``n`` equal ones each."""
    width = x.shape[1]
    p = grown.probability(x)
    node = _descend(x, feature, cut, level)
    cell = ((node[:, None] * width + np.arange(width)) * BINS + x).ravel()
    parts = (np.rint((p - y) * _PARTS), np.rint(p * (1 - p) * _PARTS), np.ones(len(x)))
    sums = [np.bincount(cell, np.repeat(part * n, width), (width * BINS) << level) for part in parts]
    return np.stack(sums, 1).astype(np.int64).reshape(1 << level, width, BINS, 3)


def _grow(
    histograms: Histograms, cuts: list[np.ndarray], mean: float, trees: int, depth: int, rate: float, ridge: float
) -> Boosted:
    inner = (1 << depth) - 1
    grown = Boosted(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)), float(np.log(mean / (1 - mean))))
    for _ in range(trees):
        feature, cut, leaf = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(inner + 1)
        for level in range(depth):
            for i, cells in enumerate(histograms(grown, feature, cut, level), (1 << level) - 1):
                g, h, count = cells[..., 0] / _PARTS, cells[..., 1] / _PARTS, cells[0, :, 2].sum()
                found = _best_cut(g, h, cuts, ridge) if count >= _LEAST else None
                if found:
                    feature[i], cut[i] = found
                if level == depth - 1:
                    left = np.arange(BINS) <= cut[i]
                    for side, own in enumerate((left, ~left)):
                        leaf[2 * i + 1 + side - inner] = -rate * g[feature[i], own].sum() / (h[feature[i], own].sum() + ridge)
        grown = Boosted(
            np.vstack([grown.feature, feature]), np.vstack([grown.cut, cut]), np.vstack([grown.leaf, leaf]), grown.base
        )
    values = [
        [cuts[f][int(c)] if np.isfinite(c) else np.inf for f, c in zip(*tree, strict=True)]
        for tree in zip(grown.feature, grown.cut, strict=True)
    ]
    return Boosted(grown.feature, np.array(values, dtype=float).reshape(-1, inner), grown.leaf, grown.base)


def _best_cut(g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray], ridge: float) -> tuple[int, int] | None:
    best, place = 1e-6, None
    whole = g[0].sum() ** 2 / (h[0].sum() + ridge)
    for f, points in enumerate(cuts):
        left_g, left_h = np.cumsum(g[f])[: len(points)], np.cumsum(h[f])[: len(points)]
        right_g, right_h = g[f].sum() - left_g, h[f].sum() - left_h
        gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - whole
        if len(gain) and gain.max() > best:
            best, place = float(gain.max()), (f, int(gain.argmax()))
    return place


def fit_boosted(
    x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0
) -> Boosted:
    """Logistic loss, second-order gains, cuts at quantiles of each feature."""
    if not len(y) or y.min() == y.max():
        return constant(float(y[0]) if len(y) else 0.5, depth)
    cuts = [np.unique(np.quantile(column, QUANTILES, method="lower")) for column in x.T]
    bins, n = binned(x, cuts), np.ones(len(y))
    return _grow(lambda *at: _histograms(bins, y, n, *at), cuts, float(y.mean()), trees, depth, rate, ridge)


def fit_boosted_rows(
    examples: DataFrame,
    cuts: list[np.ndarray],
    mean: float,
    trees: int = 40,
    depth: int = 3,
    rate: float = 0.3,
    ridge: float = 1.0,
) -> Boosted:
    """The same over ``x binary, y boolean, n long``: a byte per feature (``binned``) and how often the row stands.

    Every level of a tree is one pass over all rows; what comes back is a number
    of sums that depends on the features alone. ``mean`` is the share of ``y``.
    """
    if not 0 < mean < 1:
        return constant(mean, depth)
    width = len(cuts)

    def histograms(grown: Boosted, feature: np.ndarray, cut: np.ndarray, level: int) -> np.ndarray:
        shape = (1 << level, width, BINS, 3)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape, np.int64)
            for batch in batches:
                if len(batch):
                    x = np.frombuffer(b"".join(batch["x"].to_pylist()), np.uint8).reshape(-1, width)
                    y, n = batch["y"].to_numpy(zero_copy_only=False), batch["n"].to_numpy()
                    total += _histograms(x, y.astype(float), n, grown, feature, cut, level)
            flat = total.reshape(-1, 3)
            cell = np.flatnonzero(flat[:, 2])
            columns = [pa.array(cell), *(pa.array(flat[cell, i]) for i in range(3))]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "g", "h", "c"])

        sums = examples.select("x", "y", "n").mapInArrow(run, "cell long, g long, h long, c long").groupBy("cell")
        total = np.zeros(shape, np.int64)
        for row in sums.agg(*(F.sum(name) for name in "ghc")).collect():
            total.reshape(-1, 3)[row[0]] = row[1:]
        return total

    return _grow(histograms, cuts, mean, trees, depth, rate, ridge)
