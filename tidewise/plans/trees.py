"""Tree ensembles of one fold: a random forest (M6) and boosted trees (M7).

A walk-forward refits a model on W rows per fold, so a fold's fit is small and
there are many of them: Spark deals the folds out (``backtest.compare``, one
grouped-map job over all folds and models) and this module grows the trees
inside a group, whose W + s rows are fixed by the parameters.

Columns are binned once per fold (a bin per distinct value up to ``max_bins``,
quantile bins beyond). A tree grows level by level: the split search of a level
covers all its nodes and columns at once, from prefix sums over the rows in
(node, bin) order. The best split of a node has the largest drop of the squared
error; ties go to the first column, then to the lowest bin. That equals an
exhaustive search over all columns and bin edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np


def bin_edges(x: np.ndarray, max_bins: int) -> np.ndarray:
    """Edges between the bins of a column, halfway between the neighbouring
    values; a value belongs to the first bin whose edge is not below it."""
    values, counts = np.unique(x, return_counts=True)
    if len(values) > max_bins:
        ranks = np.arange(1, max_bins) * len(x) // max_bins
        last = np.unique(np.searchsorted(np.cumsum(counts), ranks, side="left"))
        last = last[last < len(values) - 1]
    else:
        last = np.arange(len(values) - 1)
    return (values[last] + values[last + 1]) / 2


@dataclass
class Level:
    """Rows under a level's open nodes: per column in bin order, with their
    node's number (0, 1, ...)."""

    order: np.ndarray      # (columns, rows): row numbers by bin
    node: np.ndarray       # node of each row, -1 if closed


def best_splits(level: Level, codes: np.ndarray, residual: np.ndarray, weight: np.ndarray, nodes: int,
                allowed: np.ndarray | None, min_rows: int):
    """Per open node: gain, column and bin of its best split (gain 0: none).
    ``allowed`` (nodes, columns): the columns a node may use."""
    p = len(level.order)
    own = level.node[level.order]
    place = np.argsort(own, axis=1, kind="stable")
    rows = np.take_along_axis(level.order, place, 1)
    own = np.take_along_axis(own, place, 1)
    code = codes[np.arange(p)[:, None], rows]
    w, s = weight[rows], (weight * residual)[rows]
    first = np.searchsorted(own[0], np.arange(nodes))                  # the same for every column
    total_w, total_s = np.add.reduceat(w[0], first), np.add.reduceat(s[0], first)
    before_w, before_s = np.cumsum(total_w) - total_w, np.cumsum(total_s) - total_s
    left_w, left_s = np.cumsum(w, 1) - before_w[own], np.cumsum(s, 1) - before_s[own]
    right_w, right_s = total_w[own] - left_w, total_s[own] - left_s
    ends = np.ones(own.shape, bool)                                    # last row of a bin in its node
    ends[:, :-1] = (own[:, 1:] != own[:, :-1]) | (code[:, 1:] != code[:, :-1])
    can = ends & (left_w >= min_rows) & (right_w >= min_rows)
    if allowed is not None:
        can &= allowed[own, np.arange(p)[:, None]]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(can, left_s**2 / left_w + right_s**2 / right_w - (total_s**2 / total_w)[own], 0.0)
    gain[gain <= 1e-12 * np.maximum(1e-300, np.dot(weight, residual**2))] = 0.0
    top = np.maximum.reduceat(gain, first, axis=1)                     # (columns, nodes)
    column = np.argmax(top, 0)
    best = top[column, np.arange(nodes)]
    at = np.array([f + int(np.argmax(gain[c, f:e])) for c, f, e in zip(column, first, [*first[1:], own.shape[1]])])
    return best, column, code[column, at]


@dataclass
class Ensemble:
    """``rounds`` trees of depth ``max_depth`` at most. ``boosted``: each fits
    what the trees before leave over and counts ``learning_rate`` times, on a
    random share of rows and columns. Otherwise a forest: trees on bootstrap
    samples, each node choosing among a random ``column_share`` of the columns,
    averaged. The protocol is ``fit(X, y)``, ``predict(X)``,
    ``get_feature_importance()`` (share of the squared error that a column's
    splits remove)."""

    boosted: bool
    rounds: int
    max_depth: int
    learning_rate: float = 1.0
    row_share: float = 1.0
    column_share: float = 1.0
    max_bins: int = 256
    min_rows: int = 1
    bootstrap: bool = True
    seed: int = 42
    features: Sequence[str] = ()
    edges: list[np.ndarray] = field(default_factory=list, repr=False)
    column: np.ndarray | None = field(default=None, repr=False)        # (trees, nodes), -1: a leaf
    bin: np.ndarray | None = field(default=None, repr=False)
    value: np.ndarray | None = field(default=None, repr=False)
    gains: np.ndarray | None = field(default=None, repr=False)
    base: float = 0.0

    def _codes(self, x: np.ndarray) -> np.ndarray:
        codes = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]
        return np.stack(codes) if codes else np.zeros((0, len(x)), np.int64)

    def fit(self, x, y) -> Ensemble:
        x, y = np.asarray(x, float), np.asarray(y, float)
        n, p = x.shape
        rng = np.random.default_rng(self.seed)
        self.edges = [bin_edges(x[:, j], self.max_bins) for j in range(p)]
        codes = self._codes(x)
        order = np.argsort(codes, axis=1, kind="stable")
        shape = (self.rounds, 2 ** (self.max_depth + 1) - 1)
        self.column, self.bin = np.full(shape, -1, np.int16), np.zeros(shape, np.int32)
        self.value, self.gains = np.zeros(shape), np.zeros(p)
        self.base = float(y.mean()) if self.boosted else 0.0
        left = y - self.base
        chosen = max(1, int(np.ceil(self.column_share * p)))
        for t in range(self.rounds):
            if self.boosted:
                weight = (rng.random(n) < self.row_share).astype(float) if self.row_share < 1 else np.ones(n)
            else:
                weight = np.bincount(rng.integers(0, n, n), minlength=n).astype(float) if self.bootstrap else np.ones(n)
            if not weight.any():
                weight[:] = 1
            columns = np.sort(rng.permutation(p)[:chosen]) if self.boosted else np.arange(p)
            self._grow(t, codes, order, left, weight, columns, None if self.boosted else chosen, rng)
            if self.boosted:
                self.value[t] *= self.learning_rate
                left -= self.value[t, self._leaves(codes, slice(t, t + 1))[0]]
            else:
                self.value[t] /= self.rounds
        return self

    def _grow(self, t, codes, order, residual, weight, columns, per_node, rng) -> None:
        p = len(columns)
        self.value[t, 0] = np.average(residual, weights=weight)
        if not p:
            return
        own, used = codes[columns], weight > 0
        order = order[columns]
        order = order[used[order]].reshape(p, -1)
        node, at = np.zeros(len(residual), np.int16), np.zeros(1, np.int64)   # at: places of the open nodes
        for _ in range(self.max_depth):
            k = len(at)
            allowed = None
            if per_node is not None and per_node < p:
                allowed = np.argsort(np.argsort(rng.random((k, p)), 1), 1) < per_node
            gain, column, cut = best_splits(Level(order, node), own, residual, weight, k, allowed, self.min_rows)
            split = gain > 0
            if not split.any():
                break
            self.column[t, at[split]], self.bin[t, at[split]] = columns[column[split]], cut[split]
            np.add.at(self.gains, columns[column[split]], gain[split])
            # rows of nodes that did not split leave; the others go left or right
            order = order[split[node[order]]].reshape(p, -1)
            rows = order[0]
            old = node[rows]
            right = own[column[old], rows] > cut[old]
            node[rows] = 2 * (np.cumsum(split) - 1)[old] + right
            at = np.stack([2 * at[split] + 1, 2 * at[split] + 2], 1).ravel()
            sums = [np.bincount(node[rows], v, len(at)) for v in (weight[rows], (weight * residual)[rows])]
            self.value[t, at] = sums[1] / sums[0]

    def _leaves(self, codes: np.ndarray, trees: slice) -> np.ndarray:
        """(trees, rows): the node where each row ends."""
        column, cut = self.column[trees], self.bin[trees]
        at = np.zeros((len(column), codes.shape[1]), np.int64)
        tree, row = np.arange(len(column))[:, None], np.arange(codes.shape[1])[None, :]
        for _ in range(self.max_depth):
            c = column[tree, at]
            at = np.where(c < 0, at, 2 * at + 1 + (codes[c, row] > cut[tree, at]))
        return at

    def predict(self, x) -> np.ndarray:
        x = np.asarray(x, float)
        if not self.edges:
            return np.full(len(x), self.base + self.value[:, 0].sum())
        out = []
        for at in range(0, len(x), 4096):
            leaves = self._leaves(self._codes(x[at:at + 4096]), slice(None))
            out.append(self.base + np.take_along_axis(self.value, leaves, 1).sum(0))
        return np.concatenate(out) if out else np.zeros(0)

    def get_feature_importance(self) -> dict[str, float]:
        total = self.gains.sum()
        names = self.features or [str(j) for j in range(len(self.gains))]
        return {f: float(g / total) if total else 0.0 for f, g in zip(names, self.gains)}
