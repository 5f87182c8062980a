"""Near-duplicate vectors through an index of pivot permutations.

Reference points (pivots) are drawn from the vectors, those too near another
left out; each vector is described by its nearest pivots in order of nearness.  An inverted list for each pivot
holds the vectors that have it among their nearest.  Two vectors of a list
that share enough pivots are candidates, and their cosine is verified in
double precision.  A pair is handled only in the list of the first pivot it
shares, so links can be counted without gathering pairs.

Equal vectors are one member with a count of copies.  Lists that are too long
for one task are cut into slices that meet pairwise (``bounded_shards``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, bounded_shards, components, table
from ferrite.session import materialize

COSINE = 0.95
#: Nearest pivots that describe a vector, and how many two candidates share.
NEAREST, SHARED = 8, 2
#: One pivot for so many distinct vectors, and the bytes that all pivots take at most.
VECTORS_PER_PIVOT = 32
PIVOT_BYTES = 16 << 20
#: Members of a slice of a long list.
SLICE = 512
_PAIRS = 1 << 16  # pairs verified at once
_THINNED = 1024  # drawn pivots compared at once with those kept


def _unit(rows: list) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows or vanishes."""
    x = np.asarray(rows, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _valid(column: str):
    x = F.col(column)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(x.isNotNull() & (F.size(x) > 0) & ~odd & F.exists(x, lambda v: v != 0), F.lit(False))


def _apart(drawn: np.ndarray, cosine: float) -> np.ndarray:
    """The unit rows of ``drawn`` in turn, without those nearer than ``cosine`` to one kept before."""
    kept = drawn[:0]
    for i in range(0, len(drawn), _THINNED):
        some = drawn[i:i + _THINNED]
        for j in range(0, len(kept), _THINNED):
            some = some[(some @ kept[j:j + _THINNED].T < cosine).all(axis=1)]
        near, live = some @ some.T >= cosine, np.ones(len(some), bool)
        for j in range(len(some)):
            if live[j]:
                live[j + 1:] &= ~near[j, j + 1:]
        kept = np.concatenate([kept, some[live]])
    return kept


def _pivots(members: DataFrame, n: int, cosine: float) -> dict[int, np.ndarray]:
    """A bounded sample of the distinct vectors, by dimension, as unit rows.

    Pivots lie twice the link angle apart (the farthest that two vectors
    linked to a third can be), so a dense group has few pivots whatever its
    size, and its members share them.
    """
    width = members.agg(F.max(F.size("embedding"))).first()[0] or 1
    k = max(16, min(-(-n // VECTORS_PER_PIVOT), PIVOT_BYTES // (4 * width)))
    drawn = members.select("embedding").orderBy(F.xxhash64("embedding", F.lit("pivot"))).limit(k).collect()
    by_size: dict[int, list] = {}
    for r in drawn:
        by_size.setdefault(len(r.embedding), []).append(r.embedding)
    apart = 2 * cosine * cosine - 1
    return {d: _apart(_unit(rows).astype(np.float32), apart) for d, rows in by_size.items()}


def _described(members: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``members`` with ``nearest``: keys of the nearest pivots, nearest first.

    Keys are the dimension and the pivot's place in one number, so vectors of
    different dimensions never share a list.  A dimension without a pivot in
    the sample has one list of its own.
    """
    shared = members.sparkSession.sparkContext.broadcast(pivots)

    def start():
        pivots = shared.value

        def f(column):
            vectors, out = column.to_pylist(), [None] * len(column)
            sizes = np.array([len(v) for v in vectors])
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                if d not in pivots:
                    near = np.zeros((len(at), 1), np.int64)
                else:
                    far = -(_unit([vectors[i] for i in at]).astype(np.float32) @ pivots[d].T)
                    m = min(NEAREST, far.shape[1])
                    near = np.argpartition(far, m - 1, axis=1)[:, :m]
                    near = np.take_along_axis(near, np.argsort(np.take_along_axis(far, near, 1), axis=1, kind="stable"), 1)
                for i, row in zip(at.tolist(), (near + (d << 32)).tolist()):
                    out[i] = row
            return [out]
        return f

    return append_columns(members, ["embedding"], [T.StructField("nearest", T.ArrayType(T.LongType()))], start)


def _list_links(pivot: int, cross: bool, node, copies, slices, nearest, vectors, cosine: float):
    """Verified links of one shard of a pivot's list: (node, linked copies) and a spanning forest."""
    n = len(node)
    keys, place = np.unique(np.concatenate(nearest), return_inverse=True)
    has = np.zeros((n, len(keys)), np.float32)
    has[np.repeat(np.arange(n), [len(x) for x in nearest]), place] = 1
    both = has @ has.T
    earlier = has[:, keys < pivot]
    enough = np.minimum(SHARED, np.minimum.outer(*[has.sum(axis=1)] * 2))  # few pivots in all: share what there is
    maybe = np.triu((both >= enough) & (earlier @ earlier.T == 0), 1)
    if cross:
        maybe &= slices[:, None] != slices[None, :]
    a, b = np.nonzero(maybe)
    unit = _unit(vectors)
    ok = np.concatenate([np.zeros(0, bool)] + [
        np.einsum("ij,ij->i", unit[a[i:i + _PAIRS]], unit[b[i:i + _PAIRS]]) >= cosine for i in range(0, len(a), _PAIRS)])
    a, b = a[ok], b[ok]
    linked = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
    label = np.arange(n)
    while len(a):
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(linked)
    return node[some], linked[some].astype(np.int64), node[label[some]]


def links(members: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(a, b, n): vector a has n linked copies in a list, and is connected with b there.

    ``members`` has node, copies and embedding (distinct, valid); sums of n
    over a node are its links, and the (a, b) span every group.
    """
    described = materialize(_described(members, _pivots(members, members.count(), cosine)), "vectors")
    lists = described.select("node", "copies", "embedding", "nearest", F.explode("nearest").alias("pivot"))
    shards = bounded_shards(lists, "pivot", "node", SLICE).select(
        "pivot", "_i", "_k", "_slice", "node", "copies", "nearest", "embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(shard, rows):
            node, copies, slices = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 0))
            out = _list_links(shard[0], shard[1] != shard[2], node, copies, slices,
                              [r[3] for r in rows], [r[4] for r in rows], cosine)
            return pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[2]), pa.array(out[1])], names=["a", "b", "n"])

        now, rows = None, []
        for batch in batches:
            p, i, k, *rest = (c.to_pylist() for c in batch.columns)
            for shard, row in zip(zip(p, i, k), zip(*rest)):
                if shard != now:
                    if len(rows) > 1:
                        yield made(now, rows)
                    now, rows = shard, []
                rows.append(row)
        if len(rows) > 1:
            yield made(now, rows)

    dealt = shards.repartition("pivot", "_i", "_k").sortWithinPartitions("pivot", "_i", "_k", "node")
    return dealt.mapInArrow(run, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id and kept.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing and are kept; so do vectors of different dimensions.
    n_links counts rows, so repeated rows count each other.  A null vec_id is
    no id: it never names a group, and is kept only where it is alone.
    """
    rows = vectors.select("vec_id", "embedding")
    kind = rows.schema["embedding"].dataType.elementType
    good = rows.filter(_valid("embedding")).withColumn(
        "embedding", F.transform("embedding", lambda v: v + F.lit(0).cast(kind)))  # minus zero is zero
    members = materialize(good.groupBy("embedding").agg(F.min("vec_id").alias("_first"), F.count("*").alias("copies"))
                          .withColumn("node", F.monotonically_increasing_id()), "members")
    found = materialize(links(members.select("node", "copies", "embedding"), cosine), "vector-links")
    counts = found.groupBy("a").agg(F.sum("n").alias("_n")).withColumnRenamed("a", "node")
    groups = components(found.select("a", "b"))
    labelled = members.select("node", "embedding", "_first", "copies").join(groups, "node", "left").join(counts, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("_first").alias("component_id"))
    named = labelled.join(least, "component").select(
        "embedding", "component_id", (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = good.join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~_valid("embedding")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors among all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


#: The same by all pairs of rows, groups by the closure of their links.
SQL = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS MATERIALIZED (SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM good a JOIN good b ON a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
least AS (SELECT a, min(vec_id) AS least FROM reach JOIN v ON v.r = reach.b GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
named AS (SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, least) AS component_id
  FROM v LEFT JOIN least ON v.r = least.a LEFT JOIN n ON v.r = n.a)
SELECT vec_id, CAST(n_links AS BIGINT) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept FROM named"""
