"""Trees grown together: passes and groups agree, and what is shared equals what is fitted alone."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ferrite.operators import models as M
from ferrite.operators import trees
from ferrite.operators.evaluate import confusion
from ferrite.schema import KEY, TARGET
from ferrite.sources import registry


@pytest.fixture(scope="module")
def rows(spark):
    """900 rows, six features (one of few values, one constant), three folds."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(900, 6)), 2)
    x[:, 4], x[:, 5] = rng.integers(0, 3, 900), 1.0
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * x[:, 4] + rng.normal(size=900) * 0.4) > 0.8).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), i % 3, x[i].tolist()) for i in range(900)], f"{KEY} long, {TARGET} int, fold int, x array<double>")
    return df.withColumn("features", array_to_vector("x"))


@pytest.fixture(scope="module")
def table(rows):
    return trees.table(rows, KEY, TARGET, "features", "fold", range(3))


def listed(df, *names):
    return {tuple(r[n] for n in names[:-1]): r[names[-1]] for r in df.collect()}


def test_edges_and_weights(table, rows):
    assert table.n_features == 6 and table.n_train == {0: 600, 1: 600, 2: 600}
    for f in range(3):
        assert len(table.edges[f][5]) == 1 and len(table.edges[f][4]) <= 3 and len(table.edges[f][0]) > 40
        n1 = rows.filter(f"fold <> {f} and {TARGET} = 1").count()
        assert table.weights[f] == pytest.approx((600 / (2 * (600 - n1)), 600 / (2 * n1)))


def test_forest_passes_equal_groups(table):
    """Nodes split by histograms and nodes finished in a task give the same votes; so do cut and shallow trees."""
    jobs = [trees.Grown(f * 4 + i, f, 8, 2, 3, i) for f in range(3) for i in range(4)]
    whole = trees.forest_votes(table, jobs, [2, 8])
    split = trees.forest_votes(table, jobs, [2, 8], local_rows=40)
    for v in ("vote_0", "vote_1"):
        a, b = listed(whole, "job", "key", v), listed(split, "job", "key", v)
        assert len(a) == 900 * 4 and a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
    shallow = trees.forest_votes(table, [trees.Grown(g.id, g.fold, 2, 2, 3, g.bag) for g in jobs], [2], local_rows=100)
    a, b = listed(whole, "job", "key", "vote_0"), listed(shallow, "job", "key", "vote_0")
    assert all(abs(a[k] - b[k]) < 1e-9 for k in a) and len(set(a.values())) > 20


def test_booster_passes_equal_groups_and_stages_equal_fits(table):
    jobs = [trees.Grown(0, 0, 3, 10, step=0.2, stages=(2, 4)), trees.Grown(1, 1, 2, 30, step=0.1, stages=(3,))]
    groups = listed(trees.boosted_scores(table, jobs), "job", "stage", "key", "score")
    passes = listed(trees.boosted_scores(table, jobs, local_rows=100), "job", "stage", "key", "score")
    assert len(groups) == 900 and groups.keys() == passes.keys()
    assert all(abs(groups[k] - passes[k]) < 1e-9 for k in groups)
    alone = listed(trees.boosted_scores(table, [trees.Grown(0, 0, 3, 10, step=0.2, stages=(2,))]), "job", "stage", "key", "score")
    assert alone == {k: v for k, v in groups.items() if k[:2] == (0, 2)}


def stump(x, target, w, least):
    """The best split of all values by brute force: (feature, value, left mean, right mean)."""
    best = None
    for j in range(x.shape[1]):
        for v in np.unique(x[:, j])[:-1]:
            m = x[:, j] <= v
            if min(m.sum(), (~m).sum()) >= least:
                a, b = np.average(target[m], weights=w[m]), np.average(target[~m], weights=w[~m])
                gain = w[m].sum() * a ** 2 + w[~m].sum() * b ** 2
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, j, v, a, b)
    return best[1:]


def test_booster_equals_plain_boosting(spark):
    """Few different values, so that bins lose nothing: rounds of stumps by brute force."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (240, 3)).astype(float)
    y = (x[:, 0] + rng.normal(size=240) * 3 > 6).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), int(i >= 180), x[i].tolist()) for i in range(240)], f"{KEY} long, {TARGET} int, fold int, x array<double>")
    t = trees.table(df.withColumn("features", array_to_vector("x")), KEY, TARGET, "features", "fold", [1])
    got = listed(trees.boosted_scores(t, [trees.Grown(0, 1, 1, 5, step=0.3, stages=(6,))]), "key", "score")
    train, w, margin = np.arange(240) < 180, np.where(y == 1, *[t.weights[1][c] for c in (1, 0)]), np.zeros(240)
    for i in range(6):
        target = 2.0 * y - 1 if i == 0 else 4 * (2.0 * y - 1) / (1 + np.exp(2 * (2 * y - 1) * margin))
        j, v, a, b = stump(x[train], target[train], w[train], 5)
        margin += (1 if i == 0 else 0.3) * np.where(x[:, j] <= v, a, b)
    assert got == pytest.approx({(i,): 1 / (1 + np.exp(-2 * margin[i])) for i in range(180, 240)})


def test_small_groups_and_odd_tables(spark, table):
    empty = spark.createDataFrame([], f"{KEY} long, {TARGET} int, fold int, features array<double>").withColumn("features", array_to_vector("features"))
    assert trees.table(empty, KEY, TARGET, "features", "fold", range(3)).n_features == 0
    one_class = spark.createDataFrame([(i, 0, i % 2, [float(i)]) for i in range(20)], f"{KEY} long, {TARGET} int, fold int, x array<double>")
    t = trees.table(one_class.withColumn("features", array_to_vector("x")), KEY, TARGET, "features", "fold", range(2))
    votes = trees.forest_votes(t, [trees.Grown(0, 0, 5, 1, 1, 0)], [0, 5], local_rows=3).collect()
    assert len(votes) == 10 and all(r.vote_0 == r.vote_1 == 0.0 for r in votes)


def test_bags_are_poisson():
    c = trees.bag_counts(np.arange(200_000), 7)
    assert abs(c.mean() - 1) < 0.01 and abs((c == 0).mean() - np.exp(-1)) < 0.005
    assert (c != trees.bag_counts(np.arange(200_000), 8)).any() and (c == trees.bag_counts(np.arange(200_000), 7)).all()


@pytest.mark.parametrize("kind, params", [("rf", {"n_estimators": 30, "max_depth": 6, "min_samples_leaf": 2}),
                                          ("gbt", {"max_iter": 30, "max_depth": 3, "min_samples_leaf": 10})])
def test_quality_is_that_of_the_library(spark, rows, kind, params):
    train, held = rows.filter("fold <> 0"), rows.filter("fold = 0")
    ours = confusion(M.fitted_scores(kind, train, held, params)).first()["f1"]
    theirs = confusion(M.score(M.fit(kind, train, params), held)).first()["f1"]
    assert ours > 0.6 and abs(ours - theirs) < 0.08


def test_search_end_to_end(spark, rows):
    """Both searches fit for real; each draw's F1 is that of its own fit on each fold."""
    spaces = {"rf": {"n_estimators": [4, 8], "max_depth": [3, None], "min_samples_leaf": [1, 5]},
              "gbt": {"max_iter": [3, 6], "max_depth": [2, 3], "learning_rate": [0.1, 0.3], "min_samples_leaf": [20]},
              "lr": {"C": [0.1, 1], "max_iter": [3, 200]}}
    for kind, space in spaces.items():
        best, found = M.random_search(kind, rows.drop("fold", "x"), space, n_iter=6, folds=3)
        found = found.collect()
        assert len(found) == min(6, len(M.sample_param_maps(space, 6))) and all(0 <= r.cv_f1_mean <= 1 for r in found)
        assert max(r.cv_f1_mean for r in found) == next(r.cv_f1_mean for r in found if r.params == M.json.dumps(best, sort_keys=True))
        params = M.json.loads(found[-1].params)
        folds = M.cross_validated_scores(kind, rows.drop("fold", "x"), params, 3)
        per_fold = [r["f1"] for r in confusion(folds, 0.5, ["fold"]).collect()]
        assert found[-1].cv_f1_mean == pytest.approx(np.mean(per_fold), abs=1e-9)


def test_registry_makes_once(spark):
    made = []

    def make():
        made.append(1)
        return spark.range(3).withColumn("x", F.col("id") / 7)

    stamp = ["a", 1, len(made)]
    assert registry.known_table(spark, "some", stamp) is None
    a, b = (registry.stored_table(spark, "some", stamp, make) for _ in range(2))
    assert len(made) == 1 and a.collect() == b.collect() and registry.known_table(spark, "some", stamp).count() == 3
    registry.stored_table(spark, "some", [*stamp, "changed"], make)
    assert len(made) == 2
