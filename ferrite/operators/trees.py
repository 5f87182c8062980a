"""Trees of many models grown together over one table (H3, H4, H6).

A search fits many forests or boosters on the same rows.  Here all of them grow
in the same passes, and what they share is grown once.  Trees are regression
trees on weighted targets over binned features, for a forest on the label 0/1
(its variance and the Gini impurity have the same best splits), for a booster
on the residuals of the logistic loss as Spark ML defines them: the first tree
fits the labels -1 and 1, the next ones 4y / (1 + exp(2yF)), each added with
the step size.

Passes.  A node with more than ``LOCAL_ROWS`` rows is split by histograms: each
task sums (count, weight, weighted target) by bin for every such node of every
tree, the sums are added by node in the executors, and only the best split of
each node reaches the driver.  A node with no more rows than that is a group of
bounded size: its rows are sent to one task, which grows the rest of the tree.
A booster whose training rows are such a group is boosted there to its end; a
larger one takes histogram passes for every level of every round.  Both ways
give the same trees (to the order of summation).

Nothing depends on the execution: a bag draws each row's Poisson count from a
hash of row and tree, a node draws its features from a hash of tree and node.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.session import materialize

#: Rows of a node that one task may hold (about 100 bytes each), and nodes whose histograms it holds at a time.
LOCAL_ROWS = 1 << 19
SLICE = 512
#: Bins of a feature, at quantiles of the training rows.
BINS = 64
#: Values of a summary that quantiles are read from.
ACCURACY = 10_000
_SEED = 42


@dataclass(frozen=True)
class Grown:
    """What one tree or booster is grown by.  ``fold`` is left out of its training rows and scored."""
    id: int
    fold: int
    max_depth: int
    min_leaf: int = 1
    n_features: int | None = None      # features tried at a node; None: all
    bag: int | None = None             # number of the bag; None: every row once
    step: float = 0.1                  # boosters: step size
    stages: tuple[int, ...] = ()       # boosters: numbers of trees to score


@dataclass
class Table:
    """Rows ready to grow on: bin edges by fold and feature, class weights and training rows by fold."""
    rows: DataFrame                    # _key long, _fold int, _y int, _x array<double>
    edges: dict[int, list[np.ndarray]]
    weights: dict[int, tuple[float, float]]
    n_train: dict[int, int]
    n_features: int = field(default=0)
    n_rows: int = field(default=0)


# ---- hashes ----------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _draw(values: np.ndarray, *salts: int) -> np.ndarray:
    h = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        for s in salts:
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s + 1))
    return h


_POISSON = np.cumsum([np.exp(-1) / float(np.prod(np.arange(1, k + 1))) for k in range(16)])


def bag_counts(keys: np.ndarray, bag: int | None) -> np.ndarray:
    """How often each row is in a bag: Poisson with mean 1."""
    if bag is None:
        return np.ones(len(keys), np.int64)
    u = (_draw(keys, _SEED, bag) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    return np.searchsorted(_POISSON, u)


def _tried(nodes: np.ndarray, g: Grown, n_features: int) -> np.ndarray:
    """(node, feature): the features that a node may split on."""
    out = np.ones((len(nodes), n_features), bool)
    if g.n_features and g.n_features < n_features:
        h = _draw((nodes[:, None] * n_features + np.arange(n_features)[None, :]).ravel(), _SEED, -1 if g.bag is None else g.bag)
        order = np.argsort(h.reshape(len(nodes), n_features), axis=1)
        out[:] = False
        np.put_along_axis(out, order[:, :g.n_features], True, axis=1)
    return out


# ---- splits and trees in numpy --------------------------------------------

def histograms(bins: np.ndarray, at: np.ndarray, n_nodes: int, c, w, wt, tried: np.ndarray) -> np.ndarray:
    """(node, feature, bin, 3): sums of count, weight and weighted target; features not tried stay zero."""
    out = np.zeros((n_nodes, bins.shape[1], BINS, 3))
    first, every = at * BINS, tried.all()
    for f in range(bins.shape[1]):
        if every:
            i, parts = first + bins[:, f], (c, w, wt)
        else:
            some = np.flatnonzero(tried[at, f])
            i, parts = first[some] + bins[some, f], (c[some], w[some], wt[some])
        for s, v in enumerate(parts):
            out[:, f, :, s] = np.bincount(i, v, n_nodes * BINS).reshape(n_nodes, BINS)
    return out


def level_splits(bins: np.ndarray, at: np.ndarray, totals: np.ndarray, c, w, wt, tried: np.ndarray, min_leaf: int):
    """``best_splits`` of a level's nodes, ``SLICE`` nodes at a time: a deep level has many nodes and few rows in each."""
    n = len(totals)
    if n <= SLICE:
        return best_splits(histograms(bins, at, n, c, w, wt, tried), totals, tried, min_leaf)
    order = np.argsort(at, kind="stable")
    bounds, found = np.searchsorted(at[order], np.append(np.arange(0, n, SLICE), n)), []
    for k, first in enumerate(range(0, n, SLICE)):
        rows, some = order[bounds[k]:bounds[k + 1]], slice(first, first + SLICE)
        h = histograms(bins[rows], at[rows] - first, len(totals[some]), c[rows], w[rows], wt[rows], tried[some])
        found.append(best_splits(h, totals[some], tried[some], min_leaf))
    return tuple(np.concatenate(x) for x in zip(*found))


def best_splits(h: np.ndarray, totals: np.ndarray, tried: np.ndarray, min_leaf: int):
    """(feature or -1, bin, left sums) of each node: the largest gain, ties to the first feature and bin."""
    left = np.cumsum(h, axis=2)
    right = totals[:, None, None, :] - left
    with np.errstate(divide="ignore", invalid="ignore"):
        score = left[..., 2] ** 2 / left[..., 1] + right[..., 2] ** 2 / right[..., 1]
        whole = totals[:, 2] ** 2 / totals[:, 1]
    ok = (left[..., 0] >= min_leaf) & (right[..., 0] >= min_leaf) & tried[:, :, None]
    # a share of the weight, rounded: sums made in another order must not part equal gains
    with np.errstate(invalid="ignore"):
        gain = np.where(ok, np.round((score - whole[:, None, None]) / totals[:, 1][:, None, None], 9), -np.inf).reshape(len(h), -1)
    best = gain.argmax(axis=1)
    found = gain[np.arange(len(h)), best] > 0
    f, b = np.divmod(best, h.shape[2])
    return np.where(found, f, -1), b, left[np.arange(len(h)), f, b]


class Tree:
    """Nodes in arrays; a child pair stands side by side, ``left`` is 0 for a leaf."""

    def __init__(self):
        self.feature, self.bin, self.left, self.value = [-1], [0], [0], [0.0]

    def frozen(self):
        return (np.array(self.feature), np.array(self.bin), np.array(self.left), np.array(self.value))


def grown(bins: np.ndarray, c, w, t, g: Grown, root: int = 1, depth: int = 0) -> Tree:
    """The tree below node ``root`` (numbered as in a heap) on rows with counts, weights and targets."""
    tree = Tree()
    bins = np.asfortranarray(bins)  # read feature by feature
    wc, wt = w * c, w * c * t
    at, nodes, place = np.zeros(len(c), np.int64), np.array([root], np.int64), np.array([0])
    rows = np.arange(len(c))
    totals = np.array([[c.sum(), wc.sum(), wt.sum()]], float)
    tree.value[0] = totals[0, 2] / totals[0, 1] if totals[0, 1] else 0.0
    while depth < g.max_depth and len(nodes):
        tried = _tried(nodes, g, bins.shape[1])
        here = (bins, c, wc, wt) if len(rows) == len(c) else tuple(v[rows] for v in (bins, c, wc, wt))
        f, b, left = level_splits(here[0], at, totals, *here[1:], tried, g.min_leaf)
        split = np.flatnonzero(f >= 0)
        child = np.full(len(nodes), -1)
        child[split] = 2 * np.arange(len(split))
        right = totals[split] - left[split]
        first = len(tree.value)
        for k, s in enumerate(split.tolist()):
            p = place[s]
            tree.feature[p], tree.bin[p], tree.left[p] = int(f[s]), int(b[s]), first + 2 * k
        both = np.stack([left[split], right], axis=1).reshape(-1, 3)
        tree.feature += [-1] * len(both)
        tree.bin += [0] * len(both)
        tree.left += [0] * len(both)
        tree.value += (both[:, 2] / both[:, 1]).tolist()
        stay = child[at] >= 0
        rows, at = rows[stay], at[stay]
        at = child[at] + (bins[rows, f[at]] > b[at])
        nodes = np.stack([2 * nodes[split], 2 * nodes[split] + 1], axis=1).ravel()
        # nodes of too few rows, or of one label, are done
        on = both[:, 0] >= 2 * g.min_leaf
        if not g.stages:
            on &= (both[:, 2] > 0) & (both[:, 2] < both[:, 1])
        stay = on[at]
        rows, at = rows[stay], (np.cumsum(on) - 1)[at[stay]]
        nodes, place, totals, depth = nodes[on], first + np.flatnonzero(on), both[on], depth + 1
    return tree


def values(tree: Tree, bins: np.ndarray, depths: Sequence[int]) -> np.ndarray:
    """(depth, row): the value of the node that a row reaches in the tree cut at each depth (rising)."""
    feature, bin_, left, value = tree.frozen()
    at, out, d = np.zeros(len(bins), np.int64), np.empty((len(depths), len(bins))), 0
    rows = np.arange(len(bins))
    for k, depth in enumerate(depths):
        while d < depth and len(rows):
            inner = left[at[rows]] > 0
            rows = rows[inner]
            p = at[rows]
            at[rows] = left[p] + (bins[rows, feature[p]] > bin_[p])
            d += 1
        out[k] = value[at]
    return out


def residual(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """Targets of the next tree of a booster: labels -1 and 1 at first, then minus the loss's gradient."""
    s = 2.0 * y - 1
    return s if margin is None else 4 * s / (1 + np.exp(np.minimum(2 * s * margin, 700)))


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(np.minimum(-2 * margin, 700)))


# ---- tables ----------------------------------------------------------------

def table(rows: DataFrame, key: str, label: str, features: str, fold: str, folds: Sequence[int], balanced: bool = True) -> Table:
    """Rows with edges, class weights (balanced or 1) and counts of the training rows of each of ``folds``.

    Keys are whole numbers (others are hashed to 64 bits).  Edges are approximate quantiles of the training rows of the fold (values
    themselves, so a feature of few values is cut between them), one row of
    ``BINS`` numbers for each feature and fold.
    """
    out = materialize(rows.select((F.col(key).cast("long") if isinstance(rows.schema[key].dataType, T.IntegralType)
                                   else F.xxhash64(F.col(key))).alias("_key"), F.col(fold).cast("int").alias("_fold"),
                                  F.col(label).cast("int").alias("_y"), vector_to_array(features).alias("_x")), "grown-rows")
    first = out.select(F.size("_x")).first()
    n_features = first[0] if first else 0
    counts: dict[int, dict[int, int]] = defaultdict(lambda: defaultdict(int))
    n_rows = 0
    for r in out.groupBy("_fold", "_y").agg(F.count("*").alias("n")).collect():
        n_rows += r["n"]
        for f in folds:
            if r["_fold"] != f:
                counts[f][r["_y"]] += r["n"]
    cuts = _edges(out, folds, n_features)
    edges, weights, n_train = {}, {}, {}
    for f in folds:
        edges[f] = [cuts.get((f, j), np.empty(0)) for j in range(n_features)]
        n_train[f] = sum(counts[f].values())
        weights[f] = tuple(n_train[f] / (2 * counts[f][c]) if balanced and counts[f][c] else 1.0 for c in (0, 1))
    return Table(out, edges, weights, n_train, n_features, n_rows)


def summary(values_: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values, rising, with their counts; of more than ``ACCURACY`` the ones at even ranks, which count for those before them."""
    order = np.argsort(values_, kind="stable")
    v, total = values_[order], np.cumsum(counts[order])
    last = np.flatnonzero(np.append(v[1:] != v[:-1], True)) if len(v) else np.empty(0, np.int64)
    v, total = v[last], total[last]
    if len(v) > ACCURACY:
        some = np.unique(np.searchsorted(total, total[-1] * np.arange(1, ACCURACY + 1) / ACCURACY - 0.5))
        v, total = v[some], total[some]
    return v, np.diff(total, prepend=0)


def _edges(rows: DataFrame, folds: Sequence[int], n_features: int) -> dict[tuple[int, int], np.ndarray]:
    """By fold and feature: quantiles of its training rows, from summaries of each task's rows of each fold."""
    if not n_features:
        return {}

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, known = defaultdict(list), defaultdict(list)  # by fold: rows; by fold and feature: summaries

        def put(part: int) -> None:
            x = np.concatenate(waiting.pop(part))
            for j in range(n_features):
                known[part, j].append(summary(x[:, j], np.ones(len(x), np.int64)))

        for batch in batches:
            _, fold, _, x = arrays(batch, n_features)
            for part in np.unique(fold).tolist():
                waiting[part].append(x[fold == part])
                if sum(map(len, waiting[part])) >= LOCAL_ROWS:
                    put(part)
        for part in list(waiting):
            put(part)
        made = {k: summary(*(np.concatenate(x) for x in zip(*v))) for k, v in known.items()}
        if made:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in made], pa.int32()), pa.array([k[1] for k in made], pa.int32()),
                                              pa.array([v.astype(float).tobytes() for v, _ in made.values()], pa.binary()),
                                              pa.array([n.astype(np.int64).tobytes() for _, n in made.values()], pa.binary())],
                                             names=["part", "feature", "v", "n"])

    def cut(key: tuple, got: pd.DataFrame) -> pd.DataFrame:
        v, n = ([np.frombuffer(b, d) for b in got[x]] for x, d in (("v", float), ("n", np.int64)))
        found = []
        for f in folds:
            mine = [i for i, part in enumerate(got["part"]) if part != f]
            if not mine:
                continue
            values_, counts = (np.concatenate([x[i] for i in mine]) for x in (v, n))
            order = np.argsort(values_, kind="stable")
            total = np.cumsum(counts[order])
            at = np.searchsorted(total, np.ceil(total[-1] * np.arange(1, BINS) / BINS))
            found.append((f, int(key[0]), np.unique(values_[order][at]).tolist()))
        return pd.DataFrame(found, columns=["fold", "feature", "edges"])

    schema = "part int, feature int, v binary, n binary"
    found = rows.mapInArrow(summaries, schema).groupBy("feature").applyInPandas(cut, "fold int, feature int, edges array<double>")
    return {(r["fold"], r["feature"]): np.array(r["edges"], float) for r in found.collect()}  # BINS numbers a row


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.uint8) \
        if len(edges) else np.zeros((len(x), 0), np.uint8)


def arrays(batch: pa.RecordBatch, n_features: int):
    """Key, fold, label and features (row by feature) of a batch of a Table's rows."""
    key, fold, y = (batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in ("_key", "_fold", "_y"))
    x = batch.column(batch.schema.get_field_index("_x")).flatten().to_numpy(zero_copy_only=False).reshape(len(key), n_features)
    return key, fold, y, x


def _descend(splits: dict[int, tuple[int, int]], bins: np.ndarray) -> np.ndarray:
    """The node (heap number) that each row has reached; ``splits``: node to feature and bin."""
    at = np.ones(len(bins), np.int64)
    if not splits:
        return at
    known = np.array(sorted(splits), np.int64)
    f, b = (np.array([splits[n][i] for n in known.tolist()]) for i in (0, 1))
    rows = np.arange(len(bins))
    while len(rows):
        i = np.minimum(np.searchsorted(known, at[rows]), len(known) - 1)
        inner = known[i] == at[rows]
        rows, i = rows[inner], i[inner]
        at[rows] = 2 * at[rows] + (bins[rows, f[i]] > b[i])
    return at


# ---- histogram passes ------------------------------------------------------

def _split_pass(t: Table, rows: DataFrame, jobs: Sequence[Grown], splits: dict, open_: dict, margins: dict | None):
    """One level: the best split of every open node, as rows (job, node, feature, bin, left and total sums).

    ``open_``: job to its open nodes; ``margins``: job to its place in the
    column _margins (None: targets are the labels 0/1).
    """
    sent = rows.sparkSession.sparkContext.broadcast((jobs, splits, open_))
    edges, weights, n_features = t.edges, t.weights, t.n_features

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        jobs, splits, open_ = sent.value
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            key, fold, y, x = arrays(batch, n_features)
            by_fold = {f: binned(x, edges[f]) for f in {g.fold for g in jobs}}
            margin = None
            if margins is not None:
                column = batch.column(batch.schema.get_field_index("_margins"))
                margin = column.flatten().to_numpy(zero_copy_only=False).reshape(len(key), -1)
            for g in jobs:
                nodes = np.array(sorted(open_[g.id]), np.int64)
                if not len(nodes):
                    continue
                bins = by_fold[g.fold]
                c = np.where(fold != g.fold, bag_counts(key, g.bag), 0)
                node = _descend(splits[g.id], bins)
                i = np.minimum(np.searchsorted(nodes, node), len(nodes) - 1)
                some = np.flatnonzero((nodes[i] == node) & (c > 0))
                w = np.where(y[some] == 1, weights[g.fold][1], weights[g.fold][0]) * c[some]
                if margin is None:
                    target = y[some].astype(float)
                else:
                    m = margin[some, margins[g.id]]
                    target = residual(y[some], None if np.isnan(m).any() else m)
                h = histograms(bins[some], i[some], len(nodes), c[some], w, w * target, np.ones((len(nodes), n_features), bool))
                for k, n in enumerate(nodes.tolist()):
                    if h[k].any():
                        total[g.id, n] = total[g.id, n] + h[k] if (g.id, n) in total else h[k]
        if total:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int64()),
                                              pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["job", "node", "h"])

    by_id = {g.id: g for g in jobs}

    def best(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        g, node = by_id[int(key[0])], int(key[1])
        h = sum(np.frombuffer(p).reshape(n_features, BINS, 3) for p in parts["h"])
        total = h[0].sum(axis=0)
        tried = _tried(np.array([node]), g, n_features)
        f, b, left = best_splits(h[None], total[None], tried, g.min_leaf)
        return pd.DataFrame([(g.id, node, int(f[0]), int(b[0]), *left[0], *total)],
                            columns=["job", "node", "feature", "bin", "lc", "lw", "lt", "c", "w", "t"])

    found = rows.mapInArrow(sums, "job int, node long, h binary").groupBy("job", "node").applyInPandas(
        best, "job int, node long, feature int, bin int, lc double, lw double, lt double, c double, w double, t double")
    return found.collect()  # a row for each node of more than LOCAL_ROWS rows


# ---- forests ---------------------------------------------------------------

def _tops(t: Table, jobs: Sequence[Grown], most: int, local_rows: int) -> tuple[dict, dict, dict]:
    """By job: the splits of the histogram passes, the values of their nodes, and their leaves.

    A leaf's value is known, and its rows may be many; any other node that no
    pass has split is a group for one task.
    """
    splits, known = {g.id: {} for g in jobs}, {g.id: {} for g in jobs}
    closed = {g.id: set() for g in jobs}
    large = {g.id: {1} if t.n_train[g.fold] > local_rows else set() for g in jobs}
    depth = 0
    while any(large.values()) and depth < most:
        found = _split_pass(t, t.rows, jobs, splits, large, None)
        large, depth = {g.id: set() for g in jobs}, depth + 1
        for r in found:
            known[r.job][r.node] = r.t / r.w
            if r.feature < 0:
                closed[r.job].add(r.node)
            else:
                splits[r.job][r.node] = (r.feature, r.bin)
                for child, n, w, wt in ((2 * r.node, r.lc, r.lw, r.lt), (2 * r.node + 1, r.c - r.lc, r.w - r.lw, r.t - r.lt)):
                    known[r.job][child] = wt / w
                    if n > local_rows:
                        large[r.job].add(child)
    for g in jobs:  # at the last depth
        closed[g.id] |= large[g.id]
    return splits, known, closed


def _by_node(t: Table, sent, train: bool = True, rest: bool = True, n_parts: int = 0):
    """Rows by tree and node, as blobs: (job, node, part, bins, c, y, key).

    ``train``: a tree's bag; ``rest``: the rows of its left-out fold, which
    have counts of 0 and whose keys are sent.  ``n_parts`` deals the rows of a
    node to so many parts.  Leaves have a part for each batch.
    """
    edges, n_features = t.edges, t.n_features

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        jobs, splits, _, closed = sent.value
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches, 1):
            key, fold, y, x = arrays(batch, n_features)
            by_fold = {f: binned(x, edges[f]) for f in {g.fold for g in jobs}}
            out = defaultdict(list)
            for g in jobs:
                bins = by_fold[g.fold]
                c = np.where(fold != g.fold, np.minimum(bag_counts(key, g.bag), 255), 0)
                node = _descend(splits[g.id], bins)
                use = np.flatnonzero(((c > 0) & train) | ((fold == g.fold) & rest))
                # rows by node; counts of 0 are the rows to score
                order = use[np.argsort(node[use], kind="stable")]
                ends = np.flatnonzero(np.diff(node[order])) + 1
                for some in np.split(order, ends):
                    if not len(some):
                        continue
                    n = int(node[some[0]])
                    leaf = n in closed[g.id]  # only the rows to score, and those of one batch together
                    if leaf:
                        some = some[c[some] == 0]
                        if not rest:
                            continue
                    part = (task << 32) + number if leaf else (task + number) % n_parts if n_parts else 0
                    for name, v in (("job", g.id), ("node", n), ("part", part), ("bins", b"" if leaf else bins[some].tobytes()),
                                    ("c", c[some].astype(np.uint8).tobytes()), ("y", y[some].astype(np.uint8).tobytes()),
                                    ("key", key[some][c[some] == 0].tobytes())):
                        out[name].append(v)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["job"], pa.int32()), pa.array(out["node"], pa.int64()), pa.array(out["part"], pa.int64())]
                    + [pa.array(out[x], pa.binary()) for x in ("bins", "c", "y", "key")], names=list(out))

    return parts


_GROUP = "job int, node long, part long, bins binary, c binary, y binary, key binary"


def forest_votes(t: Table, jobs: Sequence[Grown], depths: Sequence[int], local_rows: int = LOCAL_ROWS) -> DataFrame:
    """The tree-vote table (job, key, y, vote_0 ...): each tree's vote on each row of its left-out fold.

    ``vote_i`` is the share of failures in the node that the tree cut at
    ``depths[i]`` (rising) gives: a tree grows by levels and no split looks at
    the depth allowed, so one tree serves every smaller depth.  Bags and
    features depend on the tree's number alone, so the first trees of a forest
    are a smaller forest.
    """
    splits, known, closed = _tops(t, jobs, max(depths), local_rows)
    sent = t.rows.sparkSession.sparkContext.broadcast((list(jobs), splits, known, closed))
    by_id = {g.id: g for g in jobs}
    weights, n_features, depths = t.weights, t.n_features, list(depths)

    names = [f"vote_{i}" for i in range(len(depths))]
    def finished(key: tuple, got: pd.DataFrame) -> pd.DataFrame:
        _, _, known, closed = sent.value
        g, node = by_id[int(key[0])], int(key[1])
        level = node.bit_length() - 1
        c, y = (np.frombuffer(b"".join(got[x]), np.uint8) for x in ("c", "y"))
        keys = np.frombuffer(b"".join(got["key"]), np.int64)
        train, rest = c > 0, c == 0
        if node in closed[g.id]:
            votes = np.full((len(depths), len(keys)), known[g.id][node])
        else:
            bins = np.frombuffer(b"".join(got["bins"]), np.uint8).reshape(-1, n_features)
            w = np.where(y[train] == 1, weights[g.fold][1], weights[g.fold][0])
            tree = grown(bins[train], c[train].astype(np.int64), w, y[train].astype(float), g, node, level)
            votes = values(tree, bins[rest], [max(d - level, 0) for d in depths])
        for i, d in enumerate(depths):  # a tree cut above this node
            if d < level:
                votes[i] = known[g.id][node >> (level - d)]
        return pd.DataFrame({"job": np.int32(g.id), "key": keys, "y": y[rest].astype(np.int32), **dict(zip(names, votes))})

    return t.rows.mapInArrow(_by_node(t, sent), _GROUP).groupBy("job", "node", "part").applyInPandas(
        finished, "job int, key long, y int, " + ", ".join(f"{n} double" for n in names))


@dataclass
class Forest:
    """A grown forest: what the passes split, and the written trees below, a row for each group."""
    jobs: list[Grown]
    splits: dict[int, dict]
    known: dict[int, dict]
    closed: dict[int, set]
    edges: dict[int, list[np.ndarray]]
    n_features: int
    below: DataFrame                   # job, node, and a Tree's arrays


_BELOW = "job int, node long, feature binary, bin binary, left binary, value binary"


def forest(t: Table, jobs: Sequence[Grown], local_rows: int | None = None) -> Forest:
    """The trees of ``jobs``, which are those of ``forest_votes``, grown and written.

    Trees grow whole in tasks that hold all rows (``held``) up to ``local_rows``
    training rows (None: ``held.FOREST_ROWS``), below histogram passes beyond.
    """
    from ferrite.operators import held
    if max((t.n_train[g.fold] for g in jobs), default=0) <= (held.FOREST_ROWS if local_rows is None else local_rows):
        none, empty = {g.id: {} for g in jobs}, {g.id: set() for g in jobs}
        return Forest(list(jobs), none, none, empty, t.edges, t.n_features, materialize(held.forest_trees(t, jobs), "forest"))
    local_rows = LOCAL_ROWS if local_rows is None else local_rows
    splits, known, closed = _tops(t, jobs, max(g.max_depth for g in jobs), local_rows)
    sent = t.rows.sparkSession.sparkContext.broadcast((list(jobs), splits, known, closed))
    by_id, weights, n_features = {g.id: g for g in jobs}, t.weights, t.n_features

    def finished(key: tuple, got: pd.DataFrame) -> pd.DataFrame:
        g, node = by_id[int(key[0])], int(key[1])
        bins, c, y = (np.frombuffer(b"".join(got[x]), np.uint8) for x in ("bins", "c", "y"))
        w = np.where(y == 1, weights[g.fold][1], weights[g.fold][0])
        tree = grown(bins.reshape(-1, n_features), c.astype(np.int64), w, y.astype(float), g, node, node.bit_length() - 1)
        made = [v.astype(d).tobytes() for v, d in zip(tree.frozen(), _TYPES)]
        return pd.DataFrame([(np.int32(g.id), node, *made)], columns=["job", "node", "feature", "bin", "left", "value"])

    below = t.rows.mapInArrow(_by_node(t, sent, rest=False), _GROUP).groupBy("job", "node").applyInPandas(finished, _BELOW)
    return Forest(list(jobs), splits, known, closed, t.edges, n_features, materialize(below, "forest"))


_TYPES = (np.int16, np.uint8, np.int32, np.float64)


def forest_scores(grown_: Forest, rows: DataFrame, local_rows: int | None = None) -> DataFrame:
    """(key, score): the mean vote of the trees on rows (_key long, _x array<double>).

    Whole trees are sent to parts of the rows (``held.forest_scores``).  Else a group is some ``local_rows`` rows at most that reach one node, and its tree.
    """
    f, fold = grown_, grown_.jobs[0].fold
    if not any(f.splits.values()) and not any(f.closed.values()):
        from ferrite.operators import held as whole
        return whole.forest_scores(f, rows, local_rows or whole.PART_ROWS)
    local_rows = local_rows or LOCAL_ROWS
    n_parts = max(1, -(-rows.count() // local_rows))
    held = Table(rows.select("_key", F.lit(fold).alias("_fold"), F.lit(0).alias("_y"), "_x"), f.edges, {}, {}, f.n_features)
    sent = rows.sparkSession.sparkContext.broadcast((f.jobs, f.splits, f.known, f.closed))
    by_id, n_features = {g.id: g for g in f.jobs}, f.n_features

    def voted(key: tuple, got: pd.DataFrame, trees_: pd.DataFrame) -> pd.DataFrame:
        g, node = by_id[int(key[0])], int(key[1])
        keys = np.frombuffer(b"".join(got["key"]), np.int64)
        if len(trees_):
            tree, bins = Tree(), np.frombuffer(b"".join(got["bins"]), np.uint8).reshape(-1, n_features)
            tree.feature, tree.bin, tree.left, tree.value = (
                np.frombuffer(trees_[n].iloc[0], d) for n, d in zip(("feature", "bin", "left", "value"), _TYPES))
            votes = values(tree, bins, [g.max_depth])[0]
        else:
            votes = np.full(len(keys), sent.value[2][g.id].get(node, 0.0))
        return pd.DataFrame({"key": keys, "vote": votes})

    below = f.below.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))))
    blocks = held.rows.mapInArrow(_by_node(held, sent, train=False, n_parts=n_parts), _GROUP)
    votes = blocks.groupBy("job", "node", "part").cogroup(below.groupBy("job", "node", "part")).applyInPandas(voted, "key long, vote double")
    return votes.groupBy("key").agg((F.sum("vote") / len(f.jobs)).alias("score"))


# ---- boosters --------------------------------------------------------------

def boosted_scores(t: Table, jobs: Sequence[Grown], local_rows: int | None = None) -> DataFrame:
    """(job, key, y, stage, score): scores of the left-out rows after each number of trees in the job's ``stages``.

    ``local_rows``: training rows that a task may hold (None: ``held.BOOSTER_ROWS``).
    """
    if local_rows is None:
        from ferrite.operators.held import BOOSTER_ROWS as local_rows
    small = [g for g in jobs if t.n_train[g.fold] <= local_rows]
    large = [g for g in jobs if t.n_train[g.fold] > local_rows]
    parts = ([_boosted_in_groups(t, small)] if small else []) + ([_boosted_in_passes(t, large)] if large else [])
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SCORES = "job int, key long, y int, stage int, score double"


def _boosted_in_groups(t: Table, jobs: Sequence[Grown]) -> DataFrame:
    """Boosters whose training rows a task holds: ``held.booster_scores``."""
    from ferrite.operators import held
    return held.booster_scores(t, jobs)


def _boosted_in_passes(t: Table, jobs: Sequence[Grown]) -> DataFrame:
    """Boosters of any number of rows: a histogram pass for each level of each round, all boosters in the same passes.

    The margins of all boosters stand with the rows, which are written anew
    after each round, so a lost executor costs one round's work at most.
    """
    place = {g.id: i for i, g in enumerate(jobs)}
    rows = t.rows.withColumn("_margins", F.array_repeat(F.lit(float("nan")), len(jobs)))
    edges, n_features, kept = t.edges, t.n_features, []
    for i in range(max(max(g.stages) for g in jobs)):
        live = [g for g in jobs if i < max(g.stages)]
        splits, leaf, open_ = ({g.id: {} for g in live}, {g.id: {} for g in live}, {g.id: {1} for g in live})
        for depth in range(max(g.max_depth for g in live)):
            found = _split_pass(t, rows, live, splits, open_, place)
            open_ = {g.id: set() for g in live}
            by_id = {g.id: g for g in live}
            for r in found:
                if r.feature < 0:
                    leaf[r.job][r.node] = r.t / r.w
                    continue
                splits[r.job][r.node] = (r.feature, r.bin)
                leaf[r.job][2 * r.node], leaf[r.job][2 * r.node + 1] = r.lt / r.lw, (r.t - r.lt) / (r.w - r.lw)
                if depth + 1 < by_id[r.job].max_depth:
                    open_[r.job] |= {2 * r.node, 2 * r.node + 1}
            if not any(open_.values()):
                break
        sent = rows.sparkSession.sparkContext.broadcast((live, splits, leaf))

        def added(batches: Iterator[pa.RecordBatch], first: bool = i == 0) -> Iterator[pa.RecordBatch]:
            live, splits, leaf = sent.value
            for batch in batches:
                key, _, _, x = arrays(batch, n_features)
                at = batch.schema.get_field_index("_margins")
                margin = batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(len(key), -1).copy()
                by_fold = {f: binned(x, edges[f]) for f in {g.fold for g in live}}
                for g in live:
                    node, inverse = np.unique(_descend(splits[g.id], by_fold[g.fold]), return_inverse=True)
                    v = np.array([leaf[g.id][n] for n in node.tolist()])[inverse]
                    margin[:, place[g.id]] = v if first else margin[:, place[g.id]] + g.step * v
                flat = pa.array(margin.ravel())
                offsets = pa.array(np.arange(0, margin.size + 1, margin.shape[1], dtype=np.int32))
                columns = list(batch.columns)
                columns[at] = pa.ListArray.from_arrays(offsets, flat)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        rows = materialize(rows.mapInArrow(added, rows.schema), "boosted-rows")
        for g in live:
            if i + 1 in g.stages:
                m = F.col("_margins")[place[g.id]]
                kept.append(rows.filter(F.col("_fold") == g.fold).select(
                    F.lit(g.id).cast("int").alias("job"), F.col("_key").alias("key"), F.col("_y").alias("y"),
                    F.lit(i + 1).cast("int").alias("stage"), (1 / (1 + F.exp(-2 * m))).alias("score")))
    out = kept[0]
    for k in kept[1:]:
        out = out.unionByName(k)
    return out
