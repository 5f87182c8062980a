"""Deep forests: the trees of the search, grown and written once, behind the interface of a fitted model."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from ferrite.operators import models as M
from ferrite.operators import trees
from ferrite.operators.evaluate import confusion
from ferrite.schema import KEY, TARGET


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(800, 5)), 2)
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=800) * 0.4) > 0.7).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(800)], f"{KEY} long, {TARGET} int, x array<double>")
    return df.select(KEY, TARGET, array_to_vector("x").alias("features"))


def test_deep_forest_is_that_of_the_search(rows):
    """No fit of Spark ML: it stops at nothing but the depth, and sends a histogram of every node from every task."""
    train, held = rows.filter(f"{KEY} % 4 <> 0"), rows.filter(f"{KEY} % 4 = 0")
    params = {"n_estimators": 20, "min_samples_leaf": 2}
    model = M.fit("rf", train, params)
    assert isinstance(model, M.GrownForest)
    got = {r[KEY]: r.score for r in M.score(model, held).collect()}
    want = {r[KEY]: r.score for r in M.fitted_scores("rf", train, held, params).collect()}
    assert len(got) == 200 and got == pytest.approx(want, abs=1e-12)
    theirs = M.random_forest(20, None, 2, weight_col="weight").fit(M.with_class_weights(train, TARGET, "weight"))
    ours, theirs = (confusion(M.score(m, held)).first()["f1"] for m in (model, theirs))
    assert ours > 0.6 and abs(ours - theirs) < 0.08


def test_passes_and_parts_do_not_count(rows):
    """Nodes split by histograms, and rows of a node scored in parts, give the same scores."""
    t = trees.table(rows.selectExpr("*", "0 as fold"), KEY, TARGET, "features", "fold", [1])
    jobs = [trees.Grown(i, 1, 9, 2, 3, i) for i in range(5)]
    held = t.rows.select("_key", "_x").filter("_key % 3 = 0").repartition(7)
    whole, split = (trees.forest(t, jobs, n) for n in (trees.LOCAL_ROWS, 60))
    assert all(not s for s in whole.splits.values()) and all(split.splits.values())
    a, b, c = ({r.key: r.score for r in trees.forest_scores(f, held, n).collect()} for f, n in ((whole, 1 << 19), (split, 1 << 19), (split, 50)))
    assert len(a) == 267 and a == pytest.approx(b, abs=1e-9) and b == pytest.approx(c, abs=1e-12)


def test_repeated_rows_and_none(rows):
    model = M.fit("rf", rows.limit(100), {"n_estimators": 3})
    twice = rows.limit(5).unionAll(rows.limit(5))
    out = model.transform(twice)
    assert out.count() == 10 and set(twice.columns) < set(out.columns) and all(abs(sum(r.probability) - 1) < 1e-12 for r in out.collect())
    assert model.transform(rows.limit(0)).count() == 0
    assert not isinstance(M.fit("rf", rows, {"n_estimators": 2, "max_depth": 3}), M.GrownForest)
