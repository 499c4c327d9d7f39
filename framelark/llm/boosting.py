"""Gradient-boosted trees in numpy with monotone constraints, flattened into node arrays for scoring."""

import numpy as np


class Forest:
    """Trees as arrays (tree, node): feature (-1: leaf), threshold, left child (right is next), value."""

    def __init__(self, feature, threshold, left, value, start):
        self.feature, self.threshold, self.left, self.value, self.start = feature, threshold, left, value, start
        self.depth = int(np.log2(feature.shape[1] + 1))

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row; all trees walk down together, a level at a time."""
        trees = np.arange(self.feature.shape[0])
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[trees, node]
            right = x[rows, np.maximum(f, 0)] > self.threshold[trees, node]
            node = np.where(f < 0, node, self.left[trees, node] + right)
        return self.start + self.value[trees, node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x, y, monotone=(), trees=40, depth=4, rate=0.2, bins=64, least=20, ridge=1.0) -> Forest:
    """Boosted logistic trees. monotone: -1, 0 or 1 by feature; the score never moves the other way in it.

    One class, or no rows, gives a forest that scores every row alike.
    """
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    n, width = x.shape
    monotone = np.asarray(monotone if len(monotone) else np.zeros(width), int)
    share = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    start = float(np.log(share / (1 - share)))
    size = 2 ** (depth + 1) - 1
    feature, threshold = np.full((trees, size), -1), np.zeros((trees, size))
    left, value = np.zeros((trees, size), int), np.zeros((trees, size))
    forest = Forest(feature, threshold, left, value, start)
    if not n or not 0 < y.sum() < n:
        return forest
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    score = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        used = 1
        todo = [(0, np.arange(n), 0, -np.inf, np.inf)]
        while todo:
            node, rows, level, low, high = todo.pop(0)
            weight = float(np.clip(g[rows].sum() / (h[rows].sum() + ridge), low, high))
            value[t, node] = rate * weight
            best = _split(binned, rows, g, h, cuts, monotone, low, high, least, ridge) if level < depth else None
            if best is None:
                score[rows] += value[t, node]
                continue
            f, b, wl, wr = best
            feature[t, node], threshold[t, node], left[t, node] = f, cuts[f][b], used
            middle = (wl + wr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(monotone[f])]
            go = binned[rows, f] <= b
            todo += [(used, rows[go], level + 1, *bounds[0]), (used + 1, rows[~go], level + 1, *bounds[1])]
            used += 2
    return forest


def _split(binned, rows, g, h, cuts, monotone, low, high, least, ridge):
    """Best (feature, bin, left weight, right weight) that gains and keeps the constraints, or None."""
    best, top = None, 1e-6
    total_g, total_h = g[rows].sum(), h[rows].sum()
    for f, c in enumerate(cuts):
        if not len(c):
            continue
        b = binned[rows, f]
        gl, hl, nl = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g[rows], h[rows], None))
        gr, hr = total_g - gl, total_h - hl
        wl, wr = np.clip(gl / (hl + ridge), low, high), np.clip(gr / (hr + ridge), low, high)
        gain = gl * wl - (hl + ridge) * wl**2 / 2 + gr * wr - (hr + ridge) * wr**2 / 2
        w = np.clip(total_g / (total_h + ridge), low, high)
        gain = gain - (total_g * w - (total_h + ridge) * w**2 / 2)
        gain[(nl < least) | (len(rows) - nl < least) | (monotone[f] * (wr - wl) < 0)] = -1
        i = int(gain.argmax())
        if gain[i] > top:
            best, top = (f, i, wl[i], wr[i]), gain[i]
    return best
