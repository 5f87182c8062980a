"""Neighbour search by groups of leaves: what is sent and kept for a point does not grow with the leaves it meets."""

import numpy as np
import pytest

from ferrite.operators import neighbors


def test_candidates_of_a_point_do_not_grow_with_leaves():
    rng = np.random.default_rng(5)
    k, leaf = 5, 64
    x = rng.normal(size=(40 * leaf, 4))
    keys = np.array([f"p{i}" for i in range(len(x))], object)
    leaves = [(f"{i:02x}", slice(i * leaf, (i + 1) * leaf)) for i in range(40)]
    group = neighbors._Group(k)
    for node, some in leaves[:4]:
        group.add(node, keys[some], x[some], np.full(leaf, 10.0))
    for node, some in leaves:
        group.meet(node, keys[some], x[some], x[some].min(axis=0), x[some].max(axis=0))
    assert group.n_found <= 5 * k * 4 * leaf + neighbors.BLOCK
    found = [(r["_k"], r["_nk"]) for part in group.nearest() for _, r in part.iterrows()]
    assert len(found) == k * 4 * leaf
    d = neighbors._distances(x[:4 * leaf], x)
    np.fill_diagonal(d, np.inf)
    assert set(found) == {(keys[i], keys[j]) for i in range(4 * leaf) for j in np.argsort(d[i])[:k]}


@pytest.mark.parametrize("bound", [1, 60, 300])
def test_groups_of_any_size_give_the_same(spark, monkeypatch, bound):
    from pyspark.sql import functions as F
    monkeypatch.setattr(neighbors, "GROUP_POINTS", bound)
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(300, 3)), 1)
    x = np.unique(x, axis=0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    got = neighbors.knn(df, "id", "x", 4, leaf_size=10)
    assert got.count() == 4 * len(x)
    d = neighbors._distances(x, x)
    np.fill_diagonal(d, np.inf)
    dist = {(r["id"], r["nn_rank"]): r["dist"] for r in got.select("id", "nn_rank", F.col("dist")).collect()}
    near = np.sort(d, axis=1)[:, :4]
    assert all(dist[i, r + 1] == near[i, r] for i in range(len(x)) for r in range(4))


def test_siblings_share_a_group(spark, monkeypatch):
    """A cut makes nodes far smaller than a group: siblings are packed, none above its bound, and every leaf has one group."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(neighbors, "GROUP_POINTS", 400)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(20_000, 3))
    pts = spark.createDataFrame([(i, x[i].tolist()) for i in range(20_000)], "_k long, _v array<double>")
    _, nodes, _ = neighbors.kd_tree(pts, 3, 20)
    got = neighbors._groups(nodes)
    leaves = nodes.where("_leaf").select("_node", "_n")
    sizes = [r["n"] for r in got.join(leaves, "_node").groupBy("_g").agg(F.sum("_n").alias("n")).collect()]
    most = min(4 * 400, 20_000 // (4 * spark.sparkContext.defaultParallelism))
    assert got.count() == leaves.count() == got.select("_node").distinct().count() and sum(sizes) == 20_000
    assert max(sizes) <= most and len(sizes) <= 3 * 20_000 / most  # before: one for each of some 250 nodes
