"""Gradient-boosted trees for two classes, and calibrated scores (numpy).

Trees are grown level by level on binned features under the logistic loss, out
of sums of gradients by node, feature and bin, whoever adds these up. Gradients
are whole multiples of 1/UNIT, so that the sums are the same in any order.
Scores are calibrated on rows that no tree has seen, by the monotone step
function of least squares.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

DEPTH, TREES, RATE, BINS, RIDGE = 3, 60, 0.25, 24, 1.0
UNIT = 1 << 20


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """Rows of features and 0/1 labels -> trees: per node the feature and the
    threshold, per leaf its value."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    cells = [(0, bin_rows(x, edges), np.ones(len(y)), y)]
    return grow({0: edges}, {0: log_odds(y.sum(), len(y))}, lambda growing, level: sums(cells, growing, level))[0]


def log_odds(positives: float, n: float) -> float:
    return float(np.log((positives + 1) / (n - positives + 1)))


def bin_rows(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """How many of each feature's edges lie below the row's value."""
    return np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1).astype(np.uint8)


class Growing:
    """Trees so far, and the one that is being grown, on binned features."""

    def __init__(self, start: float, features: int):
        self.start, self.features, self.trees = start, features, []
        self.renew()

    def renew(self) -> None:
        self.feature, self.bin = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, 255, np.int64)

    def nodes(self, bins: np.ndarray, feature: np.ndarray, split: np.ndarray, level: int) -> np.ndarray:
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for above in range(level):
            at = (1 << above) - 1 + node
            node = 2 * node + (bins[rows, feature[at]] > split[at])
        return node

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.start)
        for feature, split, value in self.trees:
            out += value[self.nodes(bins, feature, split, DEPTH)]
        return out


def sums(cells, growing: dict[int, Growing], level: int) -> dict[int, np.ndarray]:
    """Cells (kind, bins of rows, examples, right ones) -> per kind the sums of
    gradients and of weights (2 x features x nodes x bins), in UNITs."""
    out = {}
    for kind, bins, n, positives in cells:
        if kind not in growing:
            continue
        state = growing[kind]
        p = 1 / (1 + np.exp(-state.raw(bins)))
        gradient, weight = np.rint((positives - n * p) * UNIT), np.rint(n * p * (1 - p) * UNIT)
        node = state.nodes(bins, state.feature, state.bin, level) * BINS
        size = BINS << level
        found = np.empty((2, state.features, size))
        for f in range(state.features):
            key = node + bins[:, f]
            found[0, f], found[1, f] = np.bincount(key, gradient, size), np.bincount(key, weight, size)
        out[kind] = out.get(kind, 0) + found.reshape(2, state.features, 1 << level, BINS)
    return out


def grow(edges: dict[int, list[np.ndarray]], start: dict[int, float], add_up: Callable[[dict[int, Growing], int], dict[int, np.ndarray]]) -> dict[int, dict]:
    """The trees of every kind, side by side. ``add_up(growing, level)`` gives
    what ``sums`` gives for all examples."""
    growing = {k: Growing(start[k], len(e)) for k, e in edges.items()}
    for _ in range(TREES):
        leaves = {}
        for level in range(DEPTH):
            found = add_up(growing, level)
            for k, state in growing.items():
                leaves[k] = _split(state, found[k] / UNIT, edges[k], level)
        for k, state in growing.items():
            g, h = leaves[k]
            state.trees.append((state.feature, state.bin, RATE * g / (h + RIDGE)))
            state.renew()
    out = {}
    for k, state in growing.items():
        value = lambda f, b: edges[k][f][b] if b < len(edges[k][f]) else np.inf
        out[k] = {"start": state.start, "feature": np.array([t[0] for t in state.trees]), "value": np.array([t[2] for t in state.trees]),
                  "threshold": np.array([[value(f, b) for f, b in zip(t[0], t[1])] for t in state.trees], float)}
    return out


def _split(state: Growing, found: np.ndarray, edges: list[np.ndarray], level: int) -> tuple[np.ndarray, np.ndarray]:
    """Set the best split of each node of a level; the sums of the nodes below."""
    nodes = 1 << level
    (g_all, h_all) = found[:, 0].sum(2)
    gain, below = np.zeros(nodes), np.zeros((2, nodes, 2))
    below[:, :, 0] = g_all, h_all                              # a node without a split passes its rows to the left
    for f, e in enumerate(edges):
        if not len(e):
            continue
        gl, hl = np.cumsum(found[0, f], 1)[:, :len(e)], np.cumsum(found[1, f], 1)[:, :len(e)]
        gr, hr = g_all[:, None] - gl, h_all[:, None] - hl
        better = gl ** 2 / (hl + RIDGE) + gr ** 2 / (hr + RIDGE) - (gl + gr) ** 2 / (hl + hr + RIDGE)
        best = better.argmax(1)
        for k in np.flatnonzero(better[np.arange(nodes), best] > gain + 1e-9):
            b = best[k]
            gain[k], state.feature[nodes - 1 + k], state.bin[nodes - 1 + k] = better[k, b], f, b
            below[:, k] = (gl[k, b], gr[k, b]), (hl[k, b], hr[k, b])
    return below[0].ravel(), below[1].ravel()


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Log odds of rows."""
    raw = np.full(len(x), model["start"])
    for feature, threshold, value in zip(model["feature"], model["threshold"], model["value"]):
        node = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            at = (1 << level) - 1 + node
            node = 2 * node + (x[np.arange(len(x)), feature[at]] > threshold[at])
        raw += value[node]
    return raw


def calibrate(raw: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ascending scores and the probability from each on: pooled neighbours.
    With ``n``, a row stands for that many examples, ``y`` of them right."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []
    for r, label, rows in zip(raw[order], y[order], np.ones(len(raw)) if n is None else n[order]):
        if pools and pools[-1][0] == r:
            pools[-1][1] += label
            pools[-1][2] += rows
        else:
            pools.append([r, float(label), float(rows)])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            _, positives, rows = pools.pop()
            pools[-1][1] += positives
            pools[-1][2] += rows
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def probability(steps: tuple[np.ndarray, np.ndarray], raw: np.ndarray) -> np.ndarray:
    at = np.searchsorted(steps[0], raw, "right") - 1
    return np.where(at < 0, 0.0, steps[1][np.maximum(at, 0)]) if len(steps[0]) else np.zeros(len(raw))


def threshold(p: np.ndarray, y: np.ndarray, precision: float, n: np.ndarray | None = None) -> float:
    """The least probability from which on the given share of rows is right; above 1 if there is none."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / (np.arange(1, len(p) + 1) if n is None else np.cumsum(n[order]))
    last = np.append(p[order][1:] != p[order][:-1], True) if len(p) else np.empty(0, bool)
    good = np.flatnonzero((right >= precision) & last & (p[order] > 0.5))
    return float(p[order][good[-1]]) if len(good) else 2.0
