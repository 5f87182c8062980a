"""Exact k nearest neighbours inside one table, without all pairs.

The points are cut into a k-d tree whose leaves hold at most
``leaf_size`` points: each level splits every oversized node 16 ways at
approximate quantiles of its widest coordinate (one ``percentile_approx``
per node, map-side combined), so no task holds a whole node and the depth
is about log16(n / leaf_size).  Every node keeps the tight bounding box of
its points.

The search is then exact without comparing all points of any group that
grows with the data; its units are leaves and groups of them, of bounded size:

1. inside its own leaf every point finds its k-th nearest distance ``r``; a
   point in a leaf of k or fewer points takes the farthest corner distance
   of its parent's box instead (the parent holds more points);
2. a descent from the root keeps, for each leaf, only the child boxes
   within the largest ``r`` of its points: pairs of leaves;
3. neighbouring leaves of ``GROUP_POINTS`` points at most are a group, held by
   one task; each leaf that one of them reaches is sent to the group once and
   passes by, nearest first.  Points within their own ``r`` of its box meet its
   points, in numpy, and ``r`` shrinks to the k-th distance met so far, so a
   group ends with k candidates a point (and ties), however many leaves it met;
4. candidates are ranked by (distance, md5 of the neighbour key, key).

Every point within ``r`` lies in a box within ``r`` (box distances are
computed with the same floating-point operations, and are never larger
than the distance to a point inside), so the answer is exact whatever the
quantiles were.  Identical vectors cannot be split apart: callers with
repeated vectors use ``knn_points``, which collapses them first.  Each
level is written to the shared folder, so lineage stays short and a lost
executor repeats one level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferrite.session import materialize

LEAF_SIZE = 1024
FANOUT = 16  # one hex digit of the node path per level
#: Points that one task holds while leaves pass by; distances that it computes at a time.
GROUP_POINTS, BLOCK = 1 << 16, 1 << 17


def _sum_sq(terms: Column) -> Column:
    return F.aggregate(F.transform(terms, lambda t: t * t), F.lit(0.0), lambda s, v: s + v)


def _parent(node: Column) -> Column:
    return F.substring(node, F.lit(1), F.length(node) - 1)


def _node_stats(points: DataFrame, dim: int) -> DataFrame:
    x = [F.col("_v")[i] for i in range(dim)]
    return points.groupBy("_node").agg(F.count(F.lit(1)).alias("_n"),
                                       F.array(*[F.min(c) for c in x]).alias("_lo"),
                                       F.array(*[F.max(c) for c in x]).alias("_hi"))


def kd_tree(points: DataFrame, dim: int, leaf_size: int = LEAF_SIZE, fanout: int = FANOUT):
    """Cut ``(_k, _v)`` into leaves: (leaf points ``(_k, _v, _node)``, nodes, rows per depth).

    A cut makes ``fanout`` parts at most (16 or fewer).  ``_node`` is the hex path from the root (``''``); nodes carry ``_n``,
    the box ``_lo``/``_hi`` and ``_leaf``.  A node is split when it holds
    more than ``leaf_size`` points and they differ in some coordinate; the
    split puts the smallest and the largest value of the widest coordinate
    into different children, so every node is smaller than its parent and the
    splitting ends.
    """
    active = materialize(points.select("_k", "_v", F.lit("").alias("_node")))
    stats = materialize(_node_stats(active, dim))
    qs = [i / fanout for i in range(1, fanout)]
    spread = F.zip_with("_hi", "_lo", lambda h, lo: h - lo)
    leaf_parts, node_parts, sizes = [], [], []
    while True:
        stats = stats.withColumn("_leaf", (F.col("_n") <= leaf_size) | (F.array_max(spread) <= 0))
        node_parts.append(stats.select("_node", "_n", "_lo", "_hi", "_leaf"))
        sizes.append(stats.count())
        split = stats.where(~F.col("_leaf"))
        if split.isEmpty():
            leaf_parts.append(active)
            break
        split = split.select("_node", F.array_position(spread, F.array_max(spread)).cast("int").alias("_d"))
        split = split.join(stats.select("_node", "_hi"), "_node").select(
            "_node", "_d", F.element_at("_hi", F.col("_d")).alias("_mx"))
        split = materialize(split)
        leaf_parts.append(active.join(split.select("_node"), "_node", "left_anti"))
        x = F.element_at("_v", F.col("_d"))
        sub = active.join(split, "_node")
        cuts = sub.groupBy("_node").agg(F.percentile_approx(x, qs, 10000).alias("_b"))
        cuts = split.join(cuts, "_node")
        sub = active.join(cuts, "_node")
        # All cuts equal to the maximum: count cuts <= x, else cuts < x.
        child = F.when(F.element_at("_b", 1) < F.col("_mx"), F.size(F.filter("_b", lambda b: b < x))) \
                 .otherwise(F.size(F.filter("_b", lambda b: b <= x)))
        active = materialize(sub.select("_k", "_v", F.concat("_node", F.hex(child)).alias("_node")))
        stats = materialize(_node_stats(active, dim))
    leaves = leaf_parts[0]
    for p in leaf_parts[1:]:
        leaves = leaves.unionByName(p)
    nodes = node_parts[0]
    for p in node_parts[1:]:
        nodes = nodes.unionByName(p)
    return materialize(leaves), materialize(nodes), sizes


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, the squares summed coordinate by coordinate."""
    total = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        total += (a[:, j, None] - b[None, :, j]) ** 2
    return np.sqrt(total)


def _to_box(a: np.ndarray, lo: np.ndarray, hi: np.ndarray, farthest: bool = False) -> np.ndarray:
    """Distance from each point to the box; never above that to a point inside (``farthest``: never below)."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        x = a[:, j]
        gap = np.maximum(abs(x - lo[j]), abs(x - hi[j])) if farthest else np.maximum(0.0, np.maximum(lo[j] - x, x - hi[j]))
        total += gap ** 2
    return np.sqrt(total)


def _own_radii(k: int):
    """Per leaf: each point's k-th distance inside it, and the largest of them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            radii = []
            for vectors, lo, hi in zip(batch["_vs"], batch["_plo"], batch["_phi"]):
                x = vectors.reshape(-1, len(lo))
                if len(x) > k:
                    d = _distances(x, x)
                    np.fill_diagonal(d, np.inf)
                    radii.append(np.partition(d, k - 1, axis=1)[:, k - 1])
                else:
                    radii.append(_to_box(x, lo, hi, farthest=True))
            yield pd.DataFrame({"_node": batch["_node"], "_rs": [r.tolist() for r in radii], "_r": [float(r.max()) for r in radii]})
    return run


class _Group:
    """Points of neighbouring leaves and the nearest others that they have met so far, ties included."""

    def __init__(self, k: int):
        self.k, self.nodes, self.keys, self.parts, self.radii, self.x = k, [], [], [], [], None
        self.found, self.n_found = [], 0

    def add(self, node: str, keys, x: np.ndarray, radii: np.ndarray) -> None:
        self.nodes.append(node)
        self.keys.append(np.asarray(keys, object))
        self.parts.append(x)
        self.radii.append(radii)

    def _begin(self) -> None:
        self.x, self.bound, self.keys = np.concatenate(self.parts), np.concatenate(self.radii), np.concatenate(self.keys)
        starts = np.cumsum([0] + [len(p) for p in self.parts])
        self.start = dict(zip(self.nodes, starts.tolist()))
        self.best = np.full((len(self.x), self.k), np.inf)
        self.lo, self.hi, self.parts, self.radii = self.x.min(axis=0), self.x.max(axis=0), [], []

    def meet(self, node: str, keys, y: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
        """Points within their bound of the leaf's box are compared with the leaf's points; bounds shrink."""
        if self.x is None:
            self._begin()
        near = np.flatnonzero(_to_box(self.x, lo, hi) <= self.bound)
        keys, at = np.asarray(keys, object), self.start.get(node)
        # where all values are one, the difference is zero and adds nothing
        varied = np.flatnonzero((self.lo != lo) | (self.hi != hi) | (lo != hi))
        y = np.ascontiguousarray(y[:, varied])
        step = max(1, BLOCK // len(y))
        for first in range(0, len(near), step):
            rows = near[first:first + step]
            d = _distances(self.x[np.ix_(rows, varied)], y)
            if at is not None:
                mine = np.flatnonzero((rows >= at) & (rows < at + len(y)))
                d[mine, rows[mine] - at] = np.inf
            hit = np.flatnonzero(d.min(axis=1) <= self.bound[rows])
            rows, d = rows[hit], d[hit]
            both = np.concatenate([self.best[rows], d], axis=1)
            self.best[rows] = np.partition(both, self.k - 1, axis=1)[:, :self.k]
            self.bound[rows] = np.minimum(self.bound[rows], self.best[rows].max(axis=1))
            i, j = np.nonzero(d <= self.bound[rows, None])
            self.found.append((rows[i], keys[j], d[i, j]))
            self.n_found += len(i)
        if self.n_found > 4 * self.k * len(self.x) + BLOCK:
            self._prune()

    def _prune(self) -> None:
        i, keys, d = (np.concatenate(p) for p in zip(*self.found))
        kept = d <= self.bound[i]
        self.found = [(i[kept], keys[kept], d[kept])]
        self.n_found = int(kept.sum())

    def nearest(self) -> Iterator[pd.DataFrame]:
        if self.n_found:
            self._prune()
            i, keys, d = self.found[0]
            for at in range(0, len(i), BLOCK):
                some = slice(at, at + BLOCK)
                yield pd.DataFrame({"_k": self.keys[i[some]], "_nk": keys[some], "dist": d[some]})


def _group_candidates(k: int):
    """Rows by group: first its own leaves (with radii), then the leaves that they reach, the nearest first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, group = None, None
        for batch in batches:
            for g, radii, node, keys, vectors, lo, hi in zip(*(batch[c] for c in ("_g", "_rs", "_node", "_ks", "_vs", "_lo", "_hi"))):
                if g != name:
                    if group is not None:
                        yield from group.nearest()
                    name, group = g, _Group(k)
                x = vectors.reshape(-1, len(lo))
                if radii is not None:
                    group.add(node, keys, x, radii)
                else:
                    group.meet(node, keys, x, lo, hi)
        if group is not None:
            yield from group.nearest()
    return run


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def pair_batches(spark: SparkSession):
    """Arrow batches of 16 MB, as a row is a leaf; the setting is put back at the end.

    What is to run under it must be written before the block ends.
    """
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(16 << 20))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)


def knn(points: DataFrame, key: str, vec: str, k: int = 5, leaf_size: int = LEAF_SIZE) -> DataFrame:
    """(key, nn_rank 1..k, nn_key, dist) for every point; ties by md5 of the neighbour key."""
    pts = points.select(F.col(key).alias("_k"), F.col(vec).alias("_v"))
    first = pts.first()
    if first is None:
        raise ValueError(f"need more than k={k} points, got 0")
    with pair_batches(points.sparkSession):
        top = materialize(_knn(pts, len(first["_v"]), k, leaf_size), "neighbors")
    return top.select(F.col("_k").alias(key), "nn_rank", F.col("_nk").alias("nn_key"), "dist")


def _knn(pts: DataFrame, dim: int, k: int, leaf_size: int) -> DataFrame:
    """(_k, _nk, dist, nn_rank) of points (_k, _v)."""
    leaves, nodes, sizes = kd_tree(pts, dim, max(leaf_size, 2 * (k + 1)))
    n = nodes.where(F.col("_node") == "").first()["_n"]
    if n <= k:
        raise ValueError(f"need more than k={k} points, got {n}")

    # 1. One row for each leaf (at most leaf_size points, or identical vectors).
    key_type = pts.schema["_k"].dataType.simpleString()
    parents = nodes.select(F.col("_node").alias("_p"), F.col("_lo").alias("_plo"), F.col("_hi").alias("_phi"))
    blocks = materialize(leaves.groupBy("_node").agg(F.collect_list(F.struct("_k", "_v")).alias("_pts")).select(
        "_node", F.col("_pts._k").alias("_ks"), F.flatten("_pts._v").alias("_vs")))
    radii = blocks.join(parents, _parent(F.col("_node")) == F.col("_p")).select("_node", "_vs", "_plo", "_phi") \
        .mapInPandas(_own_radii(k), "_node string, _rs array<double>, _r double")
    radii = materialize(radii)

    # 2. Descent: keep the child boxes within the leaf's largest r of its box.
    own = nodes.join(radii.select("_node", "_r"), "_node").select(
        F.col("_node").alias("_own"), F.col("_lo").alias("_alo"), F.col("_hi").alias("_ahi"), "_r", F.col("_leaf"))
    frontier = own.drop("_leaf").withColumn("_at", F.lit(""))
    gap = F.sqrt(_sum_sq(F.transform("_alo", lambda lo, i: F.greatest(
        F.lit(0.0), F.element_at("_lo", i + 1) - F.element_at("_ahi", i + 1), lo - F.element_at("_hi", i + 1)))))
    reached = [nodes.where((F.col("_node") == "") & F.col("_leaf")).select(F.col("_node").alias("_own"), "_node", F.lit(0.0).alias("_gap"))]
    for depth in range(1, len(sizes)):
        ch = nodes.where(F.length("_node") == depth).select(
            _parent(F.col("_node")).alias("_at"), F.col("_node").alias("_child"), "_lo", "_hi", "_leaf")
        step = frontier.join(ch, "_at").withColumn("_gap", gap).where(F.col("_gap") <= F.col("_r"))
        step = materialize(step.select("_own", "_alo", "_ahi", "_r", F.col("_child").alias("_at"), "_leaf", "_gap"))
        reached.append(step.where(F.col("_leaf")).select("_own", F.col("_at").alias("_node"), "_gap"))
        frontier = step.where(~F.col("_leaf")).drop("_leaf", "_gap")
    pairs = reached[0]
    for part in reached[1:]:
        pairs = pairs.unionByName(part)

    # 3. A group's own leaves, then once each leaf that one of them reaches.
    boxed = blocks.join(nodes.select("_node", "_lo", "_hi"), "_node")
    mine = _groups(nodes).join(radii.select("_node", "_rs"), "_node")
    wanted = pairs.join(mine.select(F.col("_node").alias("_own"), "_g"), "_own").groupBy("_g", "_node").agg(F.min("_gap").alias("_gap"))
    rows = boxed.join(mine, "_node").withColumn("_gap", F.lit(-1.0)).unionByName(
        boxed.join(wanted, "_node").withColumn("_rs", F.lit(None).cast("array<double>")))
    cand = rows.select("_g", "_gap", "_rs", "_node", "_ks", "_vs", "_lo", "_hi").repartition("_g").sortWithinPartitions("_g", "_gap", "_node") \
        .mapInPandas(_group_candidates(k), f"_k {key_type}, _nk {key_type}, dist double")

    # 4. The k best of them.
    order = Window.partitionBy("_k").orderBy("dist", F.md5(F.col("_nk").cast("string")), "_nk")
    return cand.withColumn("nn_rank", F.row_number().over(order)).where(F.col("nn_rank") <= k)


def _groups(nodes: DataFrame) -> DataFrame:
    """(_node, _g): each leaf's highest ancestor of ``GROUP_POINTS`` points or fewer, else the leaf itself.

    Siblings stand together in one group where that leaves four groups a core
    and a group below four times as many points: a leaf is sent once to each
    group that reaches it, and a cut makes nodes sixteen times smaller at once.
    """
    few = nodes.where(F.col("_n") <= GROUP_POINTS).select(F.col("_node").alias("_up"))
    up = F.explode(F.transform(F.sequence(F.lit(0), F.length("_node")), lambda i: F.substring(F.col("_node"), F.lit(1), i)))
    known = nodes.where("_leaf").select("_node", up.alias("_up")).join(few, "_up").groupBy("_node").agg(
        F.min_by("_up", F.length("_up")).alias("_g"))
    alone = nodes.where("_leaf").select("_node").join(known, "_node", "left").select("_node", F.coalesce("_g", "_node").alias("_g"))
    cores = nodes.sparkSession.sparkContext.defaultParallelism
    n = nodes.where(F.col("_node") == "").first()["_n"]
    half = max(1, min(4 * GROUP_POINTS, n // (4 * cores)) // 2)  # of a group's points: what is begun below is ended below twice that
    before = Window.partitionBy("_p").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)  # 16 rows or fewer
    small = nodes.where((F.col("_n") <= half) & (F.col("_node") != "")).select(F.col("_node").alias("_g"), "_n").join(
        alone.select("_g").distinct(), "_g").withColumn("_p", _parent(F.col("_g")))
    packs = small.select("_g", F.concat("_p", F.lit("+"), F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / half).cast("string")).alias("_pack"))
    return alone.join(packs, "_g", "left").select("_node", F.coalesce("_pack", "_g").alias("_g"))


def knn_points(points: DataFrame, key: str, vec: str, k: int = 5, seed=42, search: Callable[..., DataFrame] = knn) -> DataFrame:
    """k-NN over points that may repeat: (key, nn_rank, nn_key, dist), as exact as ``search`` is.

    Identical vectors are collapsed first (one row per distinct vector with
    its multiplicity), so a vector repeated by a third of all rows is one
    row for the grid search.  A point's nearest points are then the other
    copies of its own vector (distance 0; taken cyclically in hash order,
    so every copy gets different partners), followed by copies of the
    nearest other distinct vectors in distance order.  Nothing pairs the
    members of a group with each other: each point emits at most k rows.
    """
    from ferrite.functions import hash_key
    from ferrite.operators.ordered import hash_ranks

    pts = points.select(F.col(key).alias("_k"), F.col(vec).alias("_v"))
    pts = pts.withColumn("_vid", F.md5(F.to_json(F.col("_v"))))
    members = hash_ranks(pts.withColumn("_h", hash_key(seed, "_k")), ["_vid"], "_h", "_k",
                         rank_col="_q").select("_k", "_vid", "_q")
    distinct = pts.groupBy("_vid").agg(F.first("_v").alias("_v"), F.count(F.lit(1)).alias("_m"))
    distinct = materialize(distinct)
    sizes = distinct.select("_vid", "_m")
    n_distinct = distinct.count()
    mem = members.join(sizes, "_vid")

    # Own copies: t = 1..min(k, m-1), partner rank ((q-1+t) mod m) + 1.
    own_n = F.least(F.lit(k), F.col("_m") - 1)
    own = mem.where(own_n > 0).select("_k", "_vid", "_q", "_m",
                                      F.explode(F.sequence(F.lit(1), own_n.cast("int"))).alias("_t"))
    own = own.select("_k", F.col("_t").alias("nn_rank"), "_vid",
                     (F.pmod(F.col("_q") - 1 + F.col("_t"), F.col("_m")) + 1).alias("_pq"))
    own = own.join(members.select(F.col("_vid"), F.col("_q").alias("_pq"), F.col("_k").alias("nn_key")),
                   ["_vid", "_pq"]).select("_k", "nn_rank", "nn_key", F.lit(0.0).alias("dist"))

    parts = [own]
    if n_distinct > 1:
        kd = min(k, n_distinct - 1)
        near = _knn_subset(distinct, kd, search)
        # Copies still needed per point: need = k - min(k, m-1).
        w = Window.partitionBy("_vid").orderBy("nn_rank")  # at most k rows per vector
        near = near.join(sizes.select(F.col("_vid").alias("nn_vid"), F.col("_m").alias("_mn")), "nn_vid")
        near = near.withColumn("_before", F.coalesce(F.sum("_mn").over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        need = F.lit(k) - F.least(F.lit(k), F.col("_m") - 1)
        take = F.least(F.greatest(need - F.col("_before"), F.lit(0)), F.col("_mn"))
        ext = mem.where(F.col("_m") <= k).join(near, "_vid").where(take > 0)
        ext = ext.select("_k", "_q", "_m", "nn_vid", "_mn", "dist", "_before",
                         F.explode(F.sequence(F.lit(1), take.cast("int"))).alias("_t"))
        ext = ext.select("_k", "nn_vid", "dist",
                         (F.least(F.lit(k), F.col("_m") - 1) + F.col("_before") + F.col("_t")).alias("nn_rank"),
                         (F.pmod(F.col("_q") - 1 + F.col("_t") - 1, F.col("_mn")) + 1).alias("_pq"))
        ext = ext.join(members.select(F.col("_vid").alias("nn_vid"), F.col("_q").alias("_pq"),
                                      F.col("_k").alias("nn_key")), ["nn_vid", "_pq"])
        parts.append(ext.select("_k", "nn_rank", "nn_key", "dist"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(F.col("_k").alias(key), F.col("nn_rank").cast("int").alias("nn_rank"),
                      F.col("nn_key").alias("nn_key"), "dist")


def _knn_subset(distinct: DataFrame, k: int, search: Callable[..., DataFrame]) -> DataFrame:
    """k-NN among distinct vectors: (_vid, nn_rank, nn_vid, dist)."""
    r = search(distinct.select("_vid", "_v"), "_vid", "_v", k)
    return r.select("_vid", "nn_rank", F.col("nn_key").alias("nn_vid"), "dist")
