"""One tree or booster grown in memory, in numpy: the work of a task of ``operators.trees`` and ``operators.held``.

The splits are those of ``trees.best_splits``.  A forest's sums are counts of
both classes, so weights and weighted targets follow from one sum a bin, and
only the features that a node tries are summed.  Large nodes are split one by
one; nodes of few rows are split together, by histograms or, where bins would
outnumber rows, along their sorted rows.  A booster sums two features at a time
in a joint histogram, and of two children only the smaller one, the other being
the parent's rest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

BINS = 64
#: Rows of a node that is split together with others, and rows of the nodes split together.
FEW, TOGETHER = 1 << 12, 1 << 16
#: Rows of a node below which its rows are put in order.
SORTED = 24
#: Rows summed at a time (numpy widens them), and cells of a joint histogram.
STRIP, JOINT = 1 << 16, 1 << 12


def coded(bins: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(feature, row): twice the bin plus the label."""
    out = np.empty((bins.shape[1], len(bins)), np.uint8)
    for f in range(bins.shape[1]):
        np.multiply(bins[:, f], 2, out=out[f])
        out[f] += y.astype(np.uint8)
    return out


def parted(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where ``m`` holds, and the others: taking by place costs a third of taking by mask."""
    return np.flatnonzero(m), np.flatnonzero(~m)


def summed(codes: np.ndarray, rows: np.ndarray | None, v: np.ndarray | None, n: int) -> np.ndarray:
    """Sums of ``v`` (1 if None; by place in ``rows``) by code."""
    many = len(codes) if rows is None else len(rows)
    out = np.zeros(n, np.int64 if v is None else np.float64)
    for at in range(0, many, STRIP):
        some = slice(at, at + STRIP)
        got = codes[some] if rows is None else codes[rows[some]]
        out += np.bincount(got, None if v is None else v[some], n)
    return out


# ---- trees of a forest -----------------------------------------------------

class Nodes:
    """The arrays of a ``trees.Tree`` under construction, in blocks; node 0 is the root."""

    def __init__(self, value: float):
        self.feature, self.bin, self.left, self.value = ([np.array([v])] for v in (-1, 0, 0, value))
        self.n, self.splits = 1, []

    def add(self, place: np.ndarray, feature: np.ndarray, bin_: np.ndarray, value: np.ndarray) -> int:
        """Split the nodes at ``place``; their children (values in pairs) begin at the place returned."""
        first = self.n
        self.splits.append((place, feature, bin_, first + 2 * np.arange(len(place))))
        self.value.append(value)
        self.n += len(value)
        return first

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        feature, bin_, left = np.full(self.n, -1), np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for place, f, b, first in self.splits:
            feature[place], bin_[place], left[place] = f, b, first
        return feature, bin_, left, np.concatenate(self.value)


def _gain(c0, c1, whole, weights):
    """Gains of splits with left class counts ``c0``, ``c1`` of nodes with class counts ``whole``."""
    w, wt = weights[0] * c0 + weights[1] * c1, weights[1] * c1
    a, at = weights[0] * whole[0] + weights[1] * whole[1], weights[1] * whole[1]
    with np.errstate(divide="ignore", invalid="ignore"):
        # a share of the weight, rounded: as in trees.best_splits
        return np.round((wt * wt / w + (at - wt) ** 2 / (a - w) - at * at / a) / a, 9)


def _by_histograms(codes, at, c, totals, tried, weights, min_leaf):
    """(feature or -1, bin, left counts of both classes) of each node."""
    n, k = tried.shape
    rows = np.arange(len(at))
    h = np.empty((n, k, BINS, 2))
    for j in range(k):
        v = codes[tried[at, j], rows].astype(np.int64)
        v += at * (2 * BINS)
        h[:, j] = np.bincount(v, c, n * 2 * BINS).reshape(n, BINS, 2)
    return _best(h, totals, tried, weights, min_leaf)


def _best(h, totals, tried, weights, min_leaf):
    left = np.cumsum(h, axis=2)
    c0, c1 = left[..., 0], left[..., 1]
    count, whole = c0 + c1, totals.sum(axis=1)[:, None, None]
    gain = _gain(c0, c1, (totals[:, 0, None, None], totals[:, 1, None, None]), weights)
    gain = np.where((count >= min_leaf) & (whole - count >= min_leaf), gain, -np.inf).reshape(len(h), -1)
    best, nodes = gain.argmax(axis=1), np.arange(len(h))
    j, b = np.divmod(best, BINS)
    return np.where(gain[nodes, best] > 0, tried[nodes, j], -1), b, left[nodes, j, b]


def _by_order(codes, at, c, totals, tried, weights, min_leaf):
    """``_by_histograms`` along the rows of each node and feature, sorted by bin."""
    n, k = tried.shape
    cell = (at[:, None] * k + np.arange(k))
    key = (cell * (2 * BINS) + codes[tried[at], np.arange(len(at))[:, None]]).ravel()
    key = np.sort((key << 8) | np.repeat(c.astype(np.int64), k))
    count, key = key & 255, key >> 8
    bin_ = key >> 1
    last = np.append(bin_[1:] != bin_[:-1], True)  # of the rows of a node, feature and bin
    sums = np.cumsum(count)[last]
    ones = np.cumsum(count * (key & 1))[last]
    bin_ = bin_[last]
    cell = bin_ >> 6
    first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))  # every cell has rows: those of its node
    before = np.repeat(np.arange(n * k), np.diff(np.append(first, len(cell))))
    base, base1 = (np.append(0, v)[first][before] for v in (sums[:-1], ones[:-1]))
    sums, ones = sums - base, ones - base1
    node = cell // k
    whole = totals.sum(axis=1)[node]
    ok = np.flatnonzero((sums >= min_leaf) & (whole - sums >= min_leaf))
    f, b, left = np.full(n, -1), np.zeros(n, np.int64), np.zeros((n, 2))
    if not len(ok):
        return f, b, left
    node, c1 = node[ok], ones[ok]
    c0 = sums[ok] - c1
    gain = _gain(c0, c1, (totals[node, 0], totals[node, 1]), weights)
    start = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    most = np.maximum.reduceat(gain, start)
    is_best = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(start, len(node)))))
    is_best = is_best[np.append(True, node[is_best][1:] != node[is_best][:-1])]  # the first of equal ones
    is_best = is_best[gain[is_best] > 0]
    m, at_cell, at_bin = node[is_best], cell[ok][is_best] % k, bin_[ok][is_best] & (BINS - 1)
    f[m], b[m] = tried[m, at_cell], at_bin
    left[m] = np.stack([c0[is_best], c1[is_best]], axis=1)
    return f, b, left


def forest_tree(codes: np.ndarray, c: np.ndarray, weights: tuple[float, float], max_depth: int, min_leaf: int, tries,
                root: int = 1, depth: int = 0) -> Nodes:
    """The tree below node ``root`` (numbered as in a heap) on rows of ``coded`` features (one at least) that count ``c`` times (255 at most).

    ``tries``: the features that each of some nodes may split on, rising.
    """
    rows = np.flatnonzero(c)
    held = c[rows]
    n = np.bincount(codes[0][rows] & 1, held, 2)
    weigh = lambda n: n[..., 1] * weights[1] / np.maximum(n[..., 0] * weights[0] + n[..., 1] * weights[1], 1e-300)
    out = Nodes(float(weigh(n)))

    def done(n, depth):
        return depth >= max_depth or n.sum() < 2 * min_leaf or not n[0] or not n[1]

    few, stack = [], [] if done(n, depth) else [(rows, held, n, root, depth, 0)]
    del rows, held
    while stack:
        rows, held, n, node, depth_, place = stack.pop()
        if len(rows) <= FEW:
            few.append((rows, held, n, node, depth_, place))
            continue
        tried = tries(np.array([node]))
        h = np.stack([summed(codes[f], rows, held, 2 * BINS).reshape(BINS, 2) for f in tried[0].tolist()])
        f, b, left = _best(h[None], n[None], tried, weights, min_leaf)
        if f[0] < 0:
            continue
        both = np.stack([left[0], n - left[0]])
        first = out.add(np.array([place]), f, b, weigh(both))
        for side, here in enumerate(parted(codes[f[0]][rows] <= 2 * b[0] + 1)):
            if not done(both[side], depth_ + 1):
                stack.append((rows[here], held[here], both[side], 2 * node + side, depth_ + 1, first + side))
    few.sort(key=lambda x: x[4])
    some, size = [], 0
    for x in few:
        some.append(x)
        size += len(x[0])
        if size >= TOGETHER:
            _few(out, codes, some, weights, max_depth, min_leaf, tries, weigh)
            some, size = [], 0
    if some:
        _few(out, codes, some, weights, max_depth, min_leaf, tries, weigh)
    return out


def _few(out: Nodes, codes, some, weights, max_depth, min_leaf, tries, weigh) -> None:
    """Grow ``some`` nodes (rows, counts, class counts, number, depth, place) to their ends, level by level."""
    rows, c = np.concatenate([x[0] for x in some]), np.concatenate([x[1] for x in some])
    codes = np.stack([f[rows] for f in codes])
    at = np.repeat(np.arange(len(some)), [len(x[0]) for x in some])
    totals = np.stack([x[2] for x in some])
    nodes, depth, place = (np.array([x[i] for x in some], np.int64) for i in (3, 4, 5))
    while len(nodes):
        tried = tries(nodes)
        f, b, left = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64), np.zeros((len(nodes), 2))
        large = np.bincount(at, minlength=len(nodes)) >= SORTED
        for these, way in ((large, _by_histograms), (~large, _by_order)):
            if not these.any():
                continue
            if these.all():
                f, b, left = way(codes, at, c, totals, tried, weights, min_leaf)
            else:
                mine = np.flatnonzero(these[at])
                f[these], b[these], left[these] = way(codes.take(mine, axis=1), (np.cumsum(these) - 1)[at[mine]], c[mine],
                                                      totals[these], tried[these], weights, min_leaf)
        split = np.flatnonzero(f >= 0)
        if not len(split):
            return
        both = np.stack([left[split], totals[split] - left[split]], axis=1).reshape(-1, 2)
        first = out.add(place[split], f[split], b[split], weigh(both))
        child = np.full(len(nodes), -1)
        child[split] = 2 * np.arange(len(split))
        depth = np.repeat(depth[split] + 1, 2)
        nodes = np.stack([2 * nodes[split], 2 * nodes[split] + 1], axis=1).ravel()
        on = (depth < max_depth) & (both.sum(axis=1) >= 2 * min_leaf) & (both > 0).all(axis=1)
        stay = np.flatnonzero(child[at] >= 0)
        now = at[stay]
        to = child[now] + (codes[f[now], stay] > 2 * b[now] + 1)
        keep = np.flatnonzero(on[to])
        stay, at = stay[keep], (np.cumsum(on) - 1)[to[keep]]
        codes, c = codes.take(stay, axis=1), c[stay]
        nodes, depth, place, totals = nodes[on], depth[on], first + np.flatnonzero(on), both[on]


# ---- boosters --------------------------------------------------------------

class Joint:
    """Features summed together: ``groups`` of them, the bins of each, and the joint codes of rows (twice the cell plus the label)."""

    def __init__(self, n_bins: Sequence[int]):
        self.n_bins, self.groups = list(n_bins), []
        size = JOINT + 1
        for f, b in enumerate(self.n_bins):
            if size * b > JOINT:
                self.groups.append([])
                size = 1
            self.groups[-1].append(f)
            size *= b

    def cells(self, group: Sequence[int]) -> int:
        return int(np.prod([self.n_bins[f] for f in group]))

    def codes(self, coded_: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        out = []
        for group in self.groups:
            code = np.zeros(len(y), np.uint16)
            for f in group:
                code *= np.uint16(self.n_bins[f])
                code += coded_[f] >> 1
            code *= np.uint16(2)
            code += y.astype(np.uint16)
            out.append(code)
        return out

    def histogram(self, joint, coded_, rows, wt, weights, n_features, counts=None) -> np.ndarray:
        """(feature, bin, 3): sums of count, weight and weighted target ``wt`` (by place) of ``rows``.

        ``counts``: the counts by feature, bin and class, if they are known.
        """
        many = len(wt)
        known = counts is not None
        if not known:
            counts = np.zeros((n_features, BINS, 2), np.int64)
        target = np.zeros((n_features, BINS))
        if many < 2 * JOINT:  # cells would outnumber rows
            got = (coded_ if rows is None else coded_[:, rows]) + (np.arange(n_features) * (2 * BINS))[:, None]
            size = n_features * 2 * BINS
            counts = np.bincount(got.ravel(), minlength=size).reshape(n_features, BINS, 2)
            target = np.bincount(got.ravel(), np.broadcast_to(wt, got.shape).ravel(), size).reshape(n_features, BINS, 2).sum(axis=2)
        else:
            for group, code in zip(self.groups, joint):
                size, n = 2 * self.cells(group), [self.n_bins[f] for f in group]
                sums, cells = np.zeros(size), np.zeros(size, np.int64)
                for at in range(0, many, STRIP):
                    some = slice(at, at + STRIP)
                    got = (code[some] if rows is None else code[rows[some]]).astype(np.int64)
                    sums += np.bincount(got, wt[some], size)
                    if not known:
                        cells += np.bincount(got, minlength=size)
                sums, cells = sums.reshape(*n, 2).sum(axis=-1), cells.reshape(*n, 2)
                for i, f in enumerate(group):
                    others = tuple(j for j in range(len(n)) if j != i)
                    target[f, :n[i]] = sums.sum(axis=others)
                    if not known:
                        counts[f, :n[i]] = cells.sum(axis=others)
        return np.stack([counts.sum(axis=2), counts @ np.asarray(weights, float), target], axis=2), counts


def boosted(coded_: np.ndarray, y: np.ndarray, held: np.ndarray, held_y: np.ndarray, n_bins: Sequence[int], weights: tuple[float, float],
            g, residual, best_splits, shared=None, made: list | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(number of trees, margins of the rows left out) after each of the stages of ``g``; its trees (``Nodes``) are added to ``made``.

    ``coded_`` and ``held`` are ``coded`` features of training rows and of rows
    left out; ``shared``: what ``start`` made of them, for other boosters too.
    """
    joint, codes, first_counts = shared or start(coded_, y, n_bins)
    n_features, n = coded_.shape
    w = np.where(y == 1, weights[1], weights[0]).astype(float)
    wt = np.empty(n)
    margin, held_margin = None, np.zeros(held.shape[1])
    all_tried = np.ones((1, n_features), bool)
    for i in range(max(g.stages)):
        for at in range(0, n, STRIP):  # in the core's cache
            some = slice(at, at + STRIP)
            np.multiply(residual(y[some], None if margin is None else margin[some]), w[some], out=wt[some])
        h, _ = joint.histogram(codes, coded_, None, wt, weights, n_features, first_counts)
        total = h[0].sum(axis=0) if n_features else np.array([n, w.sum(), wt.sum()])
        step = np.zeros(n)
        held_step = held_margin if margin is None else np.zeros(held.shape[1])
        level = [(None, None, h, total, 0)]  # rows (None: all), rows left out, sums, whole, place in the tree
        nodes = Nodes(total[2] / total[1] if total[1] else 0.0)
        for depth in range(g.max_depth + 1):
            f = b = left = None
            if depth < g.max_depth and n_features and level:
                f, b, left = best_splits(np.stack([x[2] for x in level]), np.stack([x[3] for x in level]),
                                         np.repeat(all_tried, len(level), axis=0), g.min_leaf)
            below = []
            for k, (rows, out, h, total, place) in enumerate(level):
                if f is None or f[k] < 0 or total[0] < 2 * g.min_leaf:
                    value = total[2] / total[1] if total[1] else 0.0
                    step[slice(None) if rows is None else rows] = value
                    held_step[slice(None) if out is None else out] = value
                    continue
                code, out_code, cut = coded_[f[k]], held[f[k]], 2 * b[k] + 1
                parts = parted((code if rows is None else code[rows]) <= cut)
                outs = parted((out_code if out is None else out_code[out]) <= cut)
                parts = parts if rows is None else [rows[p] for p in parts]
                outs = outs if out is None else [out[p] for p in outs]
                wholes = [left[k], total - left[k]]
                hs = [None, None]
                if depth + 1 < g.max_depth:
                    few = int(len(parts[1]) < len(parts[0]))
                    hs[few], _ = joint.histogram(codes, coded_, parts[few], wt[parts[few]], weights, n_features)
                    hs[1 - few] = h - hs[few]
                first = nodes.add(np.array([place]), f[k:k + 1], b[k:k + 1], np.array([x[2] / x[1] for x in wholes]))
                below += list(zip(parts, outs, hs, wholes, (first, first + 1)))
            level = below
            if not level:
                break
        if margin is None:
            margin = step
        else:
            step *= g.step
            margin += step
            held_margin += g.step * held_step
        if made is not None:
            made.append(nodes)
        if i + 1 in g.stages:
            yield i + 1, held_margin


def start(coded_: np.ndarray, y: np.ndarray, n_bins: Sequence[int]):
    """What all boosters of the same rows share: joint codes, and the counts of all rows."""
    joint = Joint(n_bins)
    codes = joint.codes(coded_, y)
    n_features = len(coded_)
    counts = np.zeros((n_features, BINS, 2), np.int64)
    for f in range(n_features):
        counts[f] = summed(coded_[f], None, None, 2 * BINS).reshape(BINS, 2)
    return joint, codes, counts
