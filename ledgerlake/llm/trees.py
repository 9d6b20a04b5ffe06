"""Gradient-boosted trees in numpy: trained on a bounded sample, scored from flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """A boosted model for a log-odds; node arrays of all trees, one after the other.

    Node i compares ``feature[i]`` with ``threshold[i]`` and goes to ``left[i]`` (at most) or
    ``right[i]``; a leaf has itself as both, so that scoring is ``depth`` vectorised steps.
    """

    base: float
    depth: int = 0
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows of ``x``."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root, dtype=np.int32)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            out += self.value[node]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: float = 1.0, ridge: float = 1.0, monotone: dict[int, int] | None = None) -> Trees:
    """Boosts the logistic loss with histograms over at most ``bins`` quantiles a feature.

    ``monotone`` maps a feature to +1 or -1: a split whose children's values go the other way is
    refused, and the middle of the two bounds what either side's descendants may reach, so the
    score is monotone in that feature everywhere.
    """
    monotone = monotone or {}
    rows = len(y)
    if not rows or y.min() == y.max():
        rate_1 = (y.sum() + 0.5) / (rows + 1)
        return Trees(float(np.log(rate_1 / (1 - rate_1))))
    mean = y.mean()
    model = Trees(float(np.log(mean / (1 - mean))), depth)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T, strict=True)], axis=1)
    width = bins + 1
    nodes: list[tuple[int, float, int, int, float]] = []
    roots = []
    f = np.full(rows, model.base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(rows, dtype=np.int64)
        roots.append(len(nodes))
        nodes.append((0, 0.0, len(nodes), len(nodes), 0.0))
        level = [(len(nodes) - 1, -np.inf, np.inf)]
        at[:] = level[0][0]
        for d in range(depth + 1):
            place = {n: k for k, (n, _, _) in enumerate(level)}
            key = np.full(len(nodes), -1)
            key[list(place)] = list(place.values())
            own = key[at]
            live = np.flatnonzero(own >= 0)
            n_level = len(level)
            total_g = np.bincount(own[live], g[live], n_level)
            total_h = np.bincount(own[live], h[live], n_level)
            lows, highs = np.array([b[1] for b in level]), np.array([b[2] for b in level])
            values = np.clip(-total_g / (total_h + ridge), lows, highs)
            best_gain = np.full(n_level, 1e-6)
            best: list[tuple[int, int, float, float] | None] = [None] * n_level
            if d < depth:
                for j in range(x.shape[1]):
                    if not len(cuts[j]):
                        continue
                    code = own[live] * width + binned[live, j]
                    hist_g = np.bincount(code, g[live], n_level * width).reshape(n_level, width).cumsum(axis=1)[:, : len(cuts[j])]
                    hist_h = np.bincount(code, h[live], n_level * width).reshape(n_level, width).cumsum(axis=1)[:, : len(cuts[j])]
                    rest_g, rest_h = total_g[:, None] - hist_g, total_h[:, None] - hist_h
                    wl = np.clip(-hist_g / (hist_h + ridge), lows[:, None], highs[:, None])
                    wr = np.clip(-rest_g / (rest_h + ridge), lows[:, None], highs[:, None])
                    gain = -(hist_g * wl + (hist_h + ridge) * wl**2 / 2) - (rest_g * wr + (rest_h + ridge) * wr**2 / 2) + (total_g * values + (total_h + ridge) * values**2 / 2)[:, None]
                    bad = (hist_h < least) | (rest_h < least)
                    if sign := monotone.get(j, 0):
                        bad |= sign * (wr - wl) < 0
                    gain = np.where(bad, -np.inf, gain)
                    k = gain.argmax(axis=1)
                    top = gain[np.arange(n_level), k]
                    for n in np.flatnonzero(top > best_gain):
                        best_gain[n], best[n] = top[n], (j, int(k[n]), float(wl[n, k[n]]), float(wr[n, k[n]]))
            following = []
            for k, (n, low, high) in enumerate(level):
                if best[k] is None:
                    nodes[n] = (0, 0.0, n, n, rate * float(values[k]))
                    continue
                j, cut, wl, wr = best[k]
                a = len(nodes)
                nodes.extend([(0, 0.0, a, a, 0.0), (0, 0.0, a + 1, a + 1, 0.0)])
                nodes[n] = (j, float(cuts[j][cut]), a, a + 1, 0.0)
                mid, sign = (wl + wr) / 2, monotone.get(j, 0)
                following += [(a, max(low, mid) if sign < 0 else low, min(high, mid) if sign > 0 else high), (a + 1, max(low, mid) if sign > 0 else low, min(high, mid) if sign < 0 else high)]
                here = live[own[live] == k]
                at[here] = np.where(binned[here, j] <= cut, a, a + 1)
            level = following
            if not level:
                break
        own_values = np.array([n[4] for n in nodes])
        f += own_values[at]
    model.roots = np.array(roots, dtype=np.int32)
    model.feature, model.left, model.right = (np.array([n[i] for n in nodes], dtype=np.int32) for i in (0, 2, 3))
    model.threshold, model.value = (np.array([n[i] for n in nodes], dtype=float) for i in (1, 4))
    return model


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots and the non-decreasing values at them, for ``np.interp``."""
    scores, place, counts = np.unique(score, return_inverse=True, return_counts=True)
    means = np.bincount(place, weights=y) / counts
    blocks: list[list[float]] = []  # mean, weight, first score, last score
    for s, v, n in zip(scores.tolist(), means.tolist(), counts.tolist(), strict=True):  # equal scores are one
        blocks.append([v, float(n), s, s])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, _, last = blocks.pop()
            b = blocks[-1]
            b[0], b[1], b[3] = (b[0] * b[1] + m * w) / (b[1] + w), b[1] + w, last
    knots = np.array([x for b in blocks for x in (b[2], b[3])])
    return knots, np.array([b[0] for b in blocks for _ in (0, 1)])
