"""Forests and boosters grown in tasks that hold all rows of a fold (H3, H4, H6).

A search or a forest has many trees, and a row that is sent to each of them is
sent thousands of times.  Here the trees are dealt to a few slots, a task for
each: every row is binned once a fold, packed to a byte a feature, and sent once
to each slot of its fold, whose trees all grow there (``operators.kernels``).
So what is exchanged is the table times the slots, not times the trees.  What
leaves a task are the trees, or the sums of their votes on the rows left out.

A slot holds ``FOREST_ROWS`` or ``BOOSTER_ROWS`` training rows at most (about 30
and 75 bytes each); larger tables go by the histogram passes of
``operators.trees``, which give the same trees.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrite.operators import kernels as K
from ferrite.operators import trees as T
from ferrite.session import materialize

#: Training rows that a task holds at most.
FOREST_ROWS, BOOSTER_ROWS = 1 << 25, 1 << 23
#: Rows left out whose votes are summed together.
STRIP = 1 << 15
#: Rows that a task scores at most.
PART_ROWS = 1 << 22
#: What it costs to fill a slot, in trees grown or rounds boosted.
FILLING = 1.5


# ---- slots -----------------------------------------------------------------

def _makespan(costs: Sequence[float], cores: int) -> float:
    ends = [0.0] * cores
    for c in costs:
        heapq.heapreplace(ends, ends[0] + c)
    return max(ends)


def slots(costs: dict[int, dict[int, float]], cores: int) -> list[tuple[int, list[int]]]:
    """(fold, its jobs) of each slot, the longest first; ``costs``: by fold and job.

    Jobs of a fold that stand together stay together; the number of slots is the one that ends first on ``cores``.
    """
    best = None
    for k in range(1, max(2, 1 + -(-4 * cores // max(len(costs), 1)))):
        made = []
        for fold, jobs in costs.items():
            parts = [[0.0, i, []] for i in range(min(k, len(jobs)))]
            if len(set(jobs.values())) == 1:  # of equal cost: runs of them
                for p, some in zip(parts, np.array_split(list(jobs), len(parts))):
                    p[0], p[2] = len(some) * next(iter(jobs.values())), some.tolist()
            else:
                for job, cost in sorted(jobs.items(), key=lambda x: -x[1]):
                    p = min(parts)
                    p[0], p[2] = p[0] + cost, [*p[2], job]
            made += [(c + FILLING, fold, mine) for c, _, mine in parts]
        made.sort(key=lambda x: -x[0])
        ends = _makespan([m[0] for m in made], cores)
        if best is None or ends < 0.97 * best[0]:  # a slot more is a copy of the rows more
            best = (ends, made)
    return [(fold, jobs) for _, fold, jobs in best[1]]


def _cores(df: DataFrame) -> int:
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


def _packed(t: T.Table, folds: Sequence[int]) -> DataFrame:
    """(fold, bins, out, y, key): rows of a batch, binned for each fold."""
    edges, n_features = t.edges, t.n_features

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fold, y, x = T.arrays(batch, n_features)
            for f in folds:
                blobs = [T.binned(x, edges[f]), fold == f, y.astype(np.uint8), key]
                yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32())] + [pa.array([b.tobytes()], pa.binary()) for b in blobs],
                                                 names=["fold", "bins", "out", "y", "key"])

    return t.rows.mapInArrow(parts, "fold int, bins binary, out binary, y binary, key binary")


def _dealt(t: T.Table, of: Sequence[tuple[int, list[int]]]) -> DataFrame:
    """``_packed`` rows with a column ``slot``, each slot a partition."""
    by_fold = defaultdict(list)
    for s, (fold, _) in enumerate(of):
        by_fold[fold].append(s)
    to = F.array().cast("array<int>")
    for fold, mine in by_fold.items():
        to = F.when(F.col("fold") == fold, F.array(*[F.lit(s) for s in mine])).otherwise(to)
    return _packed(t, list(by_fold)).withColumn("slot", F.explode(to)).repartitionById(len(of), F.col("slot"))


class _Held:
    """The rows of a slot: codes, labels and keys of its training rows and of those left out."""

    def __init__(self, n_train: int, n_out: int, n_features: int):
        n_features = max(1, n_features)  # rows without features: one of a single value
        self.sides = [(np.empty((n_features, n), np.uint8), np.empty(n, np.uint8), np.empty(n, np.int64)) for n in (n_train, n_out)]
        self.filled = [0, 0]

    def add(self, bins: np.ndarray, out: np.ndarray, y: np.ndarray, key: np.ndarray) -> None:
        for i, here in enumerate(K.parted(out == 0)):
            codes, ys, keys = self.sides[i]
            at = slice(self.filled[i], self.filled[i] + len(here))
            codes[:, at], ys[at], keys[at] = K.coded(bins[here], y[here]), y[here], key[here]
            self.filled[i] = at.stop

    def in_order(self, train: bool) -> None:
        """By key, in place: the order in which batches came does not count."""
        for side in self.sides[0 if train else 1:]:
            order = np.argsort(side[2], kind="stable")
            for v in (*side[0], *side[1:]):
                v[:] = v[order]


def _held(batches: Iterator[pa.RecordBatch], of, n_train: dict[int, int], n_rows: int, n_features: int) -> dict[int, _Held]:
    found: dict[int, _Held] = {}
    for batch in batches:
        names = batch.schema.names
        for r in range(batch.num_rows):
            slot, bins, out, y, key = (batch.column(names.index(n))[r] for n in ("slot", "bins", "out", "y", "key"))
            slot = slot.as_py()
            if slot not in found:
                n = n_train[of[slot][0]]
                found[slot] = _Held(n, n_rows - n, n_features)
            bins, out, y, key = (np.frombuffer(v.as_buffer(), d) for v, d in zip((bins, out, y, key), (np.uint8, np.uint8, np.uint8, np.int64)))
            bins = bins.reshape(len(y), n_features) if n_features else np.zeros((len(y), 1), np.uint8)
            found[slot].add(bins, out, y, key)
    return found


# ---- forests ---------------------------------------------------------------

def _bag(first: np.ndarray, bag: int | None) -> np.ndarray:
    """``trees.bag_counts`` (255 at most) from the first hash of the keys."""
    if bag is None:
        return np.ones(len(first), np.uint8)
    out = np.empty(len(first), np.uint8)
    for at in range(0, len(first), K.STRIP):
        h = first[at:at + K.STRIP]
        u = (T._draw(h, bag) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        c = np.zeros(len(u), np.uint8)
        for limit in T._POISSON:
            over = u > limit
            if not over.any():
                break
            c += over
        out[at:at + K.STRIP] = c
    return out


def tree(codes: np.ndarray, c: np.ndarray, weights, g: T.Grown, root: int = 1, depth: int = 0) -> T.Tree:
    """``trees.grown`` of a forest's tree, by ``kernels.forest_tree``."""
    n_features = len(codes)

    def tries(nodes: np.ndarray) -> np.ndarray:
        return np.nonzero(T._tried(nodes, g, n_features))[1].reshape(len(nodes), -1)

    out = T.Tree()
    out.feature, out.bin, out.left, out.value = K.forest_tree(codes, c, weights, g.max_depth, g.min_leaf, tries, root, depth).arrays()
    return out


def _forest_slots(t: T.Table, jobs: Sequence[T.Grown]) -> list[tuple[int, list[int]]]:
    costs: dict[int, dict[int, float]] = defaultdict(dict)
    for g in sorted(jobs, key=lambda g: (g.fold, -1 if g.bag is None else g.bag, g.id)):
        costs[g.fold][g.id] = 1.0
    return slots(costs, _cores(t.rows))


def forest_means(t: T.Table, jobs: Sequence[T.Grown], most: int, depths: Sequence[int], cells: dict[int, Sequence[tuple[int, int]]]) -> DataFrame:
    """(forest, key, y, scores): mean votes on the rows that a forest leaves out.

    A job's number is its forest's times ``most`` plus the tree's; ``cells``: by
    forest, the pairs (number of trees, place in ``depths``) of its scores.
    """
    of, by_id = _forest_slots(t, jobs), {g.id: g for g in jobs}
    weights, n_train, n_rows, n_features, depths = t.weights, t.n_train, t.n_rows, t.n_features, list(depths)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, rows in _held(batches, of, n_train, n_rows, n_features).items():
            (codes, _, keys), _ = rows.sides
            keys = T._draw(keys, T._SEED)
            rows.in_order(False)
            out, out_y, out_keys = rows.sides[1]
            mine = defaultdict(list)
            for j in of[slot][1]:
                mine[j // most].append(by_id[j])
            for forest, some in mine.items():
                some.sort(key=lambda g: g.id)
                numbers = [g.id % most for g in some]
                wanted = sorted({n for n, _ in cells[forest]})
                sums, ready = np.zeros((len(depths), out.shape[1])), {}
                for g, number in zip(some, numbers):
                    for n in wanted:  # forests of fewer trees than this slot's next
                        if numbers[0] < n <= number and n not in ready:
                            ready[n] = sums.copy()
                    made = tree(codes, _bag(keys, g.bag), weights[g.fold], g)
                    for at in range(0, out.shape[1], STRIP):
                        sums[:, at:at + STRIP] += T.values(made, np.asfortranarray(out[:, at:at + STRIP].T >> 1), depths)
                for strip, at in enumerate(range(0, out.shape[1], STRIP)):
                    here = slice(at, at + STRIP)
                    blobs = [b"" if numbers[0] >= n else ready.get(n, sums)[d, here].tobytes() for n, d in cells[forest]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([forest], pa.int32()), pa.array([strip], pa.int64()), pa.array([out_keys[here].tobytes()], pa.binary()),
                         pa.array([out_y[here].tobytes()], pa.binary()), pa.array([blobs], pa.list_(pa.binary()))],
                        names=["forest", "strip", "key", "y", "sums"])

    def added(key: tuple, got: pd.DataFrame) -> pd.DataFrame:
        forest = int(key[0])
        keys, y = np.frombuffer(got["key"].iloc[0], np.int64), np.frombuffer(got["y"].iloc[0], np.uint8)
        scores = np.zeros((len(keys), len(cells[forest])))
        for part in got["sums"]:
            for i, blob in enumerate(part):
                if len(blob):
                    scores[:, i] += np.frombuffer(blob)
        scores /= np.array([n for n, _ in cells[forest]], float)
        return pd.DataFrame({"forest": np.int32(forest), "key": keys, "y": y.astype(np.int32), "scores": list(scores)})

    sums = _dealt(t, of).mapInArrow(grow, "forest int, strip long, key binary, y binary, sums array<binary>")
    return sums.groupBy("forest", "strip").applyInPandas(added, "forest int, key long, y int, scores array<double>")


def forest_trees(t: T.Table, jobs: Sequence[T.Grown]) -> DataFrame:
    """(job, node, arrays): the whole trees of ``jobs``, whose node is the root."""
    of, by_id = _forest_slots(t, jobs), {g.id: g for g in jobs}
    weights, n_train, n_rows, n_features = t.weights, t.n_train, t.n_rows, t.n_features

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, rows in _held(batches, of, n_train, n_rows, n_features).items():
            codes, _, keys = rows.sides[0]
            keys = T._draw(keys, T._SEED)
            for g in (by_id[j] for j in of[slot][1]):
                made = tree(codes, _bag(keys, g.bag), weights[g.fold], g).frozen()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g.id], pa.int32()), pa.array([1], pa.int64())]
                    + [pa.array([v.astype(d).tobytes()], pa.binary()) for v, d in zip(made, T._TYPES)],
                    names=["job", "node", "feature", "bin", "left", "value"])

    return _dealt(t, of).mapInArrow(grow, T._BELOW)


def forest_scores(f: T.Forest, rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(key, score): ``trees.forest_scores`` of whole trees.

    A task has the trees of a slot and ``part_rows`` rows at most (22 bytes each
    for 14 features), so a row is sent once a slot and a tree once a part.
    """
    cores, edges, n_features, n_jobs = _cores(rows), f.edges[f.jobs[0].fold], f.n_features, len(f.jobs)
    n_parts = max(1, -(-rows.count() // part_rows))
    runs = np.array_split(sorted(g.id for g in f.jobs), min(2 * cores, n_jobs))
    slot_of = {j: s for s, run in enumerate(runs) for j in run.tolist()}
    deepest = max(g.max_depth for g in f.jobs)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, batch in enumerate(batches):
            key = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(key), n_features)
            yield pa.RecordBatch.from_arrays([pa.array([(task + number) % n_parts], pa.int64()), pa.array([T.binned(x, edges).tobytes()], pa.binary()),
                                              pa.array([key.tobytes()], pa.binary())], names=["part", "bins", "key"])

    def voted(key: tuple, got: pd.DataFrame, grown: pd.DataFrame) -> pd.DataFrame:
        if not len(got):
            return pd.DataFrame({"part": [], "strip": [], "key": [], "sums": []})
        keys = np.frombuffer(b"".join(got["key"]), np.int64)
        order = np.argsort(keys, kind="stable")  # the same in every slot
        bins, keys = np.frombuffer(b"".join(got["bins"]), np.uint8).reshape(len(keys), n_features)[order], keys[order]
        made, sums = T.Tree(), np.zeros(len(keys))
        for row in grown.sort_values("job").itertuples():
            made.feature, made.bin, made.left, made.value = (np.frombuffer(getattr(row, n), d) for n, d in zip(("feature", "bin", "left", "value"), T._TYPES))
            for at in range(0, len(keys), STRIP):
                sums[at:at + STRIP] += T.values(made, bins[at:at + STRIP], [deepest])[0]
        strips = range(0, len(keys), STRIP)
        return pd.DataFrame({"part": int(key[1]), "strip": list(range(len(strips))), "key": [keys[at:at + STRIP].tobytes() for at in strips],
                             "sums": [sums[at:at + STRIP].tobytes() for at in strips]})

    def added(got: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": np.frombuffer(got["key"].iloc[0], np.int64), "score": sum(np.frombuffer(s) for s in got["sums"]) / n_jobs})

    slot = F.get(F.array(*[F.lit(slot_of.get(j, 0)) for j in range(max(slot_of) + 1)]), F.col("job"))
    below = f.below.withColumns({"slot": slot, "part": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long")))})
    blocks = rows.select("_key", "_x").mapInArrow(parts, "part long, bins binary, key binary").withColumn(
        "slot", F.explode(F.sequence(F.lit(0), F.lit(len(runs) - 1))))
    votes = blocks.groupBy("slot", "part").cogroup(below.groupBy("slot", "part")).applyInPandas(
        voted, "part long, strip long, key binary, sums binary")
    return votes.groupBy("part", "strip").applyInPandas(added, "key long, score double")


# ---- boosters --------------------------------------------------------------

def booster_scores(t: T.Table, jobs: Sequence[T.Grown]) -> DataFrame:
    """(job, key, y, stage, score), as ``trees.boosted_scores``."""
    costs: dict[int, dict[int, float]] = defaultdict(dict)
    for g in jobs:
        costs[g.fold][g.id] = float(max(g.stages)) * (1 + g.max_depth / 2)
    of, by_id = slots(costs, _cores(t.rows)), {g.id: g for g in jobs}
    edges, weights, n_train, n_rows, n_features = t.edges, t.weights, t.n_train, t.n_rows, t.n_features

    def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, rows in _held(batches, of, n_train, n_rows, n_features).items():
            rows.in_order(True)
            (codes, y, _), (out, out_y, keys) = rows.sides
            fold = of[slot][0]
            n_bins = [len(e) + 1 for e in edges[fold]] or [1]
            shared = K.start(codes, y, n_bins)
            for g in (by_id[j] for j in of[slot][1]):
                for stage, margin in K.boosted(codes, y, out, out_y, n_bins, weights[fold], g, T.residual, T.best_splits, shared):
                    for at in range(0, len(margin), K.STRIP):
                        here = slice(at, at + K.STRIP)
                        n = len(margin[here])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, g.id, np.int32)), pa.array(keys[here]), pa.array(out_y[here].astype(np.int32)),
                             pa.array(np.full(n, stage, np.int32)), pa.array(T.probability(margin[here]))],
                            names=["job", "key", "y", "stage", "score"])

    # written: a booster is not grown again for every reader of its scores
    return materialize(_dealt(t, of).mapInArrow(boost, T._SCORES), "boosted")


def booster_trees(t: T.Table, g: T.Grown) -> list[T.Tree]:
    """The trees of one booster, in their order; a tree has some 2 ** depth nodes, so all reach the driver."""
    of = [(g.fold, [g.id])]
    edges, weights, n_train, n_rows, n_features = t.edges, t.weights, t.n_train, t.n_rows, t.n_features

    def boost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _held(batches, of, n_train, n_rows, n_features).values():
            rows.in_order(True)
            (codes, y, _), (out, out_y, _) = rows.sides
            made: list[K.Nodes] = []
            for _ in K.boosted(codes, y, out, out_y, [len(e) + 1 for e in edges[g.fold]] or [1], weights[g.fold], g, T.residual, T.best_splits, made=made):
                pass
            for i, nodes in enumerate(made):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32())] + [pa.array([v.astype(d).tobytes()], pa.binary()) for v, d in zip(nodes.arrays(), T._TYPES)],
                    names=["number", "feature", "bin", "left", "value"])

    found = _dealt(t, of).mapInArrow(boost, "number int, feature binary, bin binary, left binary, value binary").collect()
    out = []
    for r in sorted(found, key=lambda r: r["number"]):
        made = T.Tree()
        made.feature, made.bin, made.left, made.value = (np.frombuffer(r[n], d) for n, d in zip(("feature", "bin", "left", "value"), T._TYPES))
        out.append(made)
    return out


def booster_margin(grown: Sequence[T.Tree], g: T.Grown, bins: np.ndarray) -> np.ndarray:
    """The margin of binned rows: the first tree, then each next one with the step size."""
    out = np.zeros(len(bins))
    for i, made in enumerate(grown):
        out += (g.step if i else 1.0) * T.values(made, bins, [g.max_depth])[0]
    return out
