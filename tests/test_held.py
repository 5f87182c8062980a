"""Trees and boosters grown in tasks that hold all rows: the trees of operators.trees, from rows sent once a slot."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ferrite.operators import held, kernels, trees
from ferrite.schema import KEY, TARGET


def drawn(n, seed=1):
    """Features of many, few and one values; a label that needs deep trees."""
    rng = np.random.default_rng(seed)
    bins = np.stack([rng.integers(0, 64, n), rng.integers(0, 64, n), rng.integers(0, 60, n), rng.integers(0, 5, n),
                     rng.integers(0, 2, n), np.zeros(n, int)], axis=1).astype(np.uint8)
    y = ((bins[:, 0] + bins[:, 1] + rng.integers(0, 50, n)) > 95).astype(np.uint8)
    return bins, y


def same(a: trees.Tree, b: trees.Tree, bins, depths):
    assert len(a.value) == len(b.value)
    assert np.allclose(trees.values(a, bins, depths), trees.values(b, bins, depths), rtol=0, atol=1e-9)


@pytest.mark.parametrize("depth, leaf, few", [(30, 1, 1 << 12), (30, 4, 50), (3, 2, 200), (0, 1, 5)])
def test_forest_tree_is_that_of_levels(monkeypatch, depth, leaf, few):
    monkeypatch.setattr(kernels, "FEW", few)
    bins, y = drawn(3000)
    keys = np.arange(3000) * 7
    c, g = trees.bag_counts(keys, 3), trees.Grown(0, 0, depth, leaf, 3, 3)
    weights = (0.6, 2.5)
    got = held.tree(kernels.coded(bins, y), held._bag(trees._draw(keys, trees._SEED), 3), weights, g)
    in_ = c > 0
    want = trees.grown(bins[in_], c[in_], np.where(y == 1, weights[1], weights[0])[in_], y[in_].astype(float), g)
    same(got, want, bins, [0, 2, depth] if depth > 2 else [depth])


def test_bags_are_the_same():
    keys = np.concatenate([np.arange(50_000), -np.arange(1, 50_000), np.arange(1 << 60, (1 << 60) + 9)])
    for bag in (None, 0, 299):
        assert (held._bag(trees._draw(keys, trees._SEED), bag) == trees.bag_counts(keys, bag)).all()


@pytest.mark.parametrize("joint", [1, 1 << 12])
def test_booster_is_that_of_levels(monkeypatch, joint):
    """Joint and single histograms, and the larger child as the parent's rest."""
    monkeypatch.setattr(kernels, "JOINT", joint)
    bins, y = drawn(12_000)
    train, weights = np.arange(12_000) % 4 > 0, (0.7, 1.9)
    g = trees.Grown(0, 0, 4, 15, step=0.2, stages=(2, 5))
    codes = kernels.coded(bins, y)
    got = {n: m.copy() for n, m in kernels.boosted(codes[:, train], y[train], codes[:, ~train], y[~train], [64, 64, 60, 5, 2, 1], weights, g,
                                                   trees.residual, trees.best_splits)}
    w, margin, c = np.where(y == 1, weights[1], weights[0]), None, np.ones(int(train.sum()), np.int64)
    for i in range(5):
        made = trees.grown(bins[train], c, w[train], trees.residual(y[train], None if margin is None else margin[train]), g)
        step = trees.values(made, bins, [4])[0]
        margin = step if margin is None else margin + 0.2 * step
        if i + 1 in got:
            assert np.allclose(got.pop(i + 1), margin[~train], rtol=0, atol=1e-9)
    assert not got


def test_slots_hold_every_job_once_and_copies_do_not_grow_with_trees():
    for n_trees in (100, 2700):
        of = held.slots({f: {f * n_trees + i: 1.0 for i in range(n_trees)} for f in range(3)}, 8)
        assert sorted(j for _, jobs in of for j in jobs) == list(range(3 * n_trees)) and len(of) <= 36
        assert all(j // n_trees == fold for fold, jobs in of for j in jobs)
    of = held.slots({0: {0: 9.0, 1: 1.0, 2: 1.0}, 1: {3: 5.0}}, 4)
    assert sorted(j for _, jobs in of for j in jobs) == [0, 1, 2, 3] and of[0] == (0, [0])


def test_six_million_readings_are_held():
    assert held.BOOSTER_ROWS >= 4_800_000 and held.FOREST_ROWS >= 28_800_000


@pytest.fixture(scope="module")
def table(spark):
    bins, y = drawn(700, 5)
    df = spark.createDataFrame([(i, int(y[i]), i % 3, bins[i].astype(float).tolist()) for i in range(700)],
                               f"{KEY} long, {TARGET} int, fold int, x array<double>")
    return trees.table(df.repartition(5).withColumn("features", array_to_vector("x")), KEY, TARGET, "features", "fold", range(3))


def test_means_are_those_of_the_votes(table):
    """Forests cut to fewer trees and smaller depths, whose trees stand in several slots."""
    jobs = [trees.Grown(f * 9 + i, f, 8, 2, 3, i) for f in range(3) for i in range(9)]
    cells = {f: [(9, 1), (4, 0), (9, 0)] for f in range(3)}
    got = {(r.forest, r.key): (r.y, *r.scores) for r in held.forest_means(table, jobs, 9, [2, 8], cells).collect()}
    votes = trees.forest_votes(table, jobs, [2, 8]).withColumns({"forest": F.expr("job div 9"), "tree": F.expr("job % 9")})
    want = votes.groupBy("forest", "key", "y").agg(F.avg("vote_1").alias("a"), F.avg(F.when(F.col("tree") < 4, F.col("vote_0"))).alias("b"),
                                                   F.avg("vote_0").alias("c")).collect()
    assert len(got) == len(want) == 700
    assert all(got[r.forest, r.key] == pytest.approx((r.y, r.a, r.b, r.c), abs=1e-9) for r in want)


def test_rows_are_sent_to_slots_not_to_trees(table):
    jobs = [trees.Grown(i, 0, 8, 2, 3, i) for i in range(200)]
    of = held._forest_slots(table, jobs)
    sent = held._dealt(table, of)
    assert len(of) <= 4 * 4 and sent.agg(F.sum(F.length("y"))).first()[0] == 700 * len(of)


def test_edges_are_quantiles(spark, monkeypatch):
    """Summaries of several tasks and parts, of more values than one keeps."""
    monkeypatch.setattr(trees, "LOCAL_ROWS", 3000)
    rng = np.random.default_rng(2)
    x = np.stack([rng.exponential(size=40_000), rng.integers(0, 3, 40_000).astype(float)], axis=1)
    v, n = trees.summary(x[:, 0], np.ones(40_000, np.int64))
    assert len(v) <= trees.ACCURACY and n.sum() == 40_000 and v[-1] == x[:, 0].max()
    df = spark.createDataFrame([(i, i % 2, i % 4, x[i].tolist()) for i in range(40_000)], "k long, y int, fold int, x array<double>").repartition(3)
    t = trees.table(df.withColumn("features", array_to_vector("x")), "k", "y", "features", "fold", [1, 9])
    assert t.n_rows == 40_000 and t.n_train == {1: 30_000, 9: 40_000}
    for f, mine in ((1, np.arange(40_000) % 4 != 1), (9, np.ones(40_000, bool))):
        ranks = np.searchsorted(np.sort(x[mine, 0]), t.edges[f][0], "right") / mine.sum()
        assert len(ranks) == 63 and np.abs(ranks - np.arange(1, 64) / 64).max() < 3e-4 and t.edges[f][1].tolist() == [0.0, 1.0, 2.0]


def test_unsaved_booster_is_that_of_the_search(spark, monkeypatch):
    """No fit of Spark ML, and the same scores as the fold's."""
    from ferrite.operators import models as M
    bins, y = drawn(500, 6)
    df = spark.createDataFrame([(i, int(y[i]), bins[i].astype(float).tolist()) for i in range(500)], f"{KEY} long, {TARGET} int, x array<double>")
    df = df.select(KEY, TARGET, array_to_vector("x").alias("features"))
    train, out = df.filter(f"{KEY} % 4 <> 0"), df.filter(f"{KEY} % 4 = 0")
    params = {"max_iter": 7, "max_depth": 3, "min_samples_leaf": 10}
    monkeypatch.setattr(M, "fit", None)
    got = {r[KEY]: r.score for r in M.score(M.fit_to_score("gbt", train, params), out).collect()}
    want = {r[KEY]: r.score for r in M.fitted_scores("gbt", train, out, params).collect()}
    assert len(got) == 125 and got == pytest.approx(want, abs=1e-9)


def test_parts_and_slots_of_scored_rows(spark, table):
    """Whole trees: rows in one part or in many give the mean of the single votes."""
    jobs = [trees.Grown(i, 0, 8, 2, 3, i) for i in range(20)]
    f = trees.forest(table, jobs)
    rows = table.rows.filter("_fold = 0").select("_key", "_x").repartition(6)
    one, many = ({r.key: r.score for r in held.forest_scores(f, rows, n).collect()} for n in (1 << 22, 40))
    votes = {r.key: r.v for r in trees.forest_votes(table, jobs, [8]).groupBy("key").agg(F.avg("vote_0").alias("v")).collect()}
    assert len(one) == len(votes) and one == pytest.approx(many, abs=1e-12)
    assert one == pytest.approx(votes, abs=1e-9)
