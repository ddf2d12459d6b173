"""Small learners in numpy: histogram trees, isotonic calibration and the
cyclic additive model.  They fit on bounded samples on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


#: What a split must gain in the loss: less is noise of single labels.
LEAST_GAIN = 3.0


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Inner quantile edges of each column; a value's bin is the number of
    edges below it."""
    out = []
    if not len(x):
        return [np.zeros(0) for _ in range(x.shape[1])]
    for column in x.T:
        at = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
        low = np.unique(column)
        out.append((at if len(low) > bins else (low[1:] + low[:-1]) / 2).astype(float))
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)]).astype(np.int32) if len(edges) else np.zeros((len(x), 0), np.int32)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Tree:
    """A complete tree of fixed depth: node i has children 2i+1 and 2i+2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def leaf(self, b: np.ndarray, depth: int) -> np.ndarray:
        at = np.zeros(len(b), np.int64)
        rows = np.arange(len(b))
        for _ in range(depth):
            at = 2 * at + 1 + (b[rows, self.feature[at]] > self.threshold[at])
        return at - ((1 << depth) - 1)

    def predict(self, b: np.ndarray, depth: int) -> np.ndarray:
        return self.value[self.leaf(b, depth)]


@dataclass
class BoostedTrees:
    edges: list[np.ndarray]
    trees: list[Tree]
    start: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += tree.predict(b, self.depth)
        return out


def fit_tree(b: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, bins: int, penalty: float, least: float, rate: float) -> Tree:
    inner = (1 << depth) - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, bins, np.int64)
    node = np.zeros(len(b), np.int64)
    for level in range(depth):
        first, width = (1 << level) - 1, 1 << level
        best = np.full(width, LEAST_GAIN)
        local = node - first
        for f in range(b.shape[1]):
            cell = local * bins + b[:, f]
            gs = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(axis=1)
            hs = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(axis=1)
            gt, ht = gs[:, -1:], hs[:, -1:]
            gain = gs**2 / (hs + penalty) + (gt - gs) ** 2 / (ht - hs + penalty) - gt**2 / (ht + penalty)
            gain[(hs < least) | (ht - hs < least)] = -1
            k = gain.argmax(axis=1)
            top = gain[np.arange(width), k]
            better = top > best
            best = np.where(better, top, best)
            feature[first : first + width][better] = f
            threshold[first : first + width][better] = k[better]
        node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > threshold[node])
    leaf = node - inner
    n = inner + 1
    value = -rate * np.bincount(leaf, g, n) / (np.bincount(leaf, h, n) + penalty)
    return Tree(feature, threshold, value)


def fit_boosted_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, bins: int = 64, rate: float = 0.12, penalty: float = 2.0, least: float = 1.0) -> BoostedTrees:
    edges = bin_edges(x, bins)
    b = binned(x, edges)
    p = np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4)
    start = float(np.log(p / (1 - p)))
    raw = np.full(len(y), start)
    trees = []
    for _ in range(rounds if len(y) else 0):
        q = sigmoid(raw)
        tree = fit_tree(b, q - y, q * (1 - q), depth, bins + 1, penalty, least, rate)
        trees.append(tree)
        raw += tree.predict(b, depth)
    return BoostedTrees(edges, trees, start, depth)


@dataclass
class Isotonic:
    """A monotone map from raw scores to probabilities: linear between the
    middles of the pooled blocks."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.x, self.y) if len(self.x) else sigmoid(raw)


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pooled adjacent violators; each block is drawn a little to the middle
    by one row of each label at the ends' odds, so 0 and 1 stay out."""
    if len(np.unique(y)) < 2:
        return Isotonic(np.zeros(0), np.zeros(0))
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []
    for s, t in zip(raw[order], y[order], strict=True):
        blocks.append([t, 1.0, s, s])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            a = blocks.pop()
            b = blocks[-1]
            blocks[-1] = [b[0] + a[0], b[1] + a[1], b[2], a[3]]
    prior = y.mean()
    xs, ys = [], []
    for total, n, low, high in blocks:
        p = (total + prior) / (n + 1)
        xs += [low, high] if high > low else [low]
        ys += [p, p] if high > low else [p]
    return Isotonic(np.array(xs), np.maximum.accumulate(np.array(ys)))


@dataclass
class AdditiveModel:
    """score = start + one table per feature + one table per pair of features;
    a text's score is a sum of looked-up table entries."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]
    start: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        b = binned(x, self.edges)
        for f, table in enumerate(self.tables):
            out += table[b[:, f]]
        coarse = binned(x, self.pair_edges)
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[coarse[:, i], coarse[:, j]]
        return out


def _step(g: np.ndarray, h: np.ndarray, leaves: int, penalty: float) -> np.ndarray:
    """A shallow tree on one binned feature: bins are split greedily into
    ``leaves`` runs, each with one Newton step."""
    cuts = [0, len(g)]
    gs, hs = np.concatenate([[0], g.cumsum()]), np.concatenate([[0], h.cumsum()])
    part = lambda a, b: (gs[b] - gs[a]) ** 2 / (hs[b] - hs[a] + penalty)
    for _ in range(leaves - 1):
        best = (1e-9, -1)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                k = np.arange(a + 1, b)
                gain = part(a, k) + part(k, b) - part(a, b)
                i = int(gain.argmax())
                best = max(best, (float(gain[i]), int(k[i])))
        if best[1] < 0:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = -(gs[b] - gs[a]) / (hs[b] - hs[a] + penalty)
    return out


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 150, bins: int = 48, pairs: int = 10, pair_bins: int = 8, leaves: int = 3, rate: float = 0.1, penalty: float = 2.0) -> AdditiveModel:
    """Cyclic boosting: each round visits every feature once with a small step;
    then the pairs that explain most of what is left get tables the same way."""
    edges, coarse_edges = bin_edges(x, bins), bin_edges(x, pair_bins)
    b, coarse = binned(x, edges), binned(x, coarse_edges)
    d = x.shape[1]
    p = np.clip(y.mean() if len(y) else 0.5, 1e-4, 1 - 1e-4)
    start = float(np.log(p / (1 - p)))
    tables = [np.zeros(len(e) + 1) for e in edges]
    raw = np.full(len(y), start)
    for _ in range(rounds if len(y) else 0):
        for f in range(d):
            q = sigmoid(raw)
            n = len(tables[f])
            step = rate * _step(np.bincount(b[:, f], q - y, n), np.bincount(b[:, f], q * (1 - q), n), leaves, penalty)
            tables[f] += step
            raw += step[b[:, f]]
    ranked = []
    q = sigmoid(raw)
    for i in range(d):
        for j in range(i + 1, d):
            shape = (len(coarse_edges[i]) + 1, len(coarse_edges[j]) + 1)
            cell = coarse[:, i] * shape[1] + coarse[:, j]
            g, h = (np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in (q - y, q * (1 - q)))
            # what the pair explains beyond either feature alone
            gain = (g**2 / (h + penalty)).sum() - (g.sum(1) ** 2 / (h.sum(1) + penalty)).sum() - (g.sum(0) ** 2 / (h.sum(0) + penalty)).sum()
            ranked.append((gain, i, j))
    chosen = [(i, j) for gain, i, j in sorted(ranked, reverse=True)[:pairs] if gain > 0] if len(y) else []
    pair_tables = [np.zeros((len(coarse_edges[i]) + 1, len(coarse_edges[j]) + 1)) for i, j in chosen]
    for _ in range(rounds // 2):
        for (i, j), table in zip(chosen, pair_tables, strict=True):
            q = sigmoid(raw)
            cell = coarse[:, i] * table.shape[1] + coarse[:, j]
            g, h = (np.bincount(cell, w, table.size).reshape(table.shape) for w in (q - y, q * (1 - q)))
            step = -rate * g / (h + 4 * penalty)
            table += step
            raw += step[coarse[:, i], coarse[:, j]]
    return AdditiveModel(edges, tables, chosen, coarse_edges, pair_tables, start)
