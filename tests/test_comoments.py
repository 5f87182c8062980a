"""Correlations from masked co-moments against numpy and Spark's corr."""

import numpy as np
import pytest

from ferrite.operators.profile import correlation_matrix


def _found(df, cols):
    return {(r.col_a, r.col_b): r.r for r in correlation_matrix(df, cols).collect()}


def test_pairs_equal_numpy_over_many_tasks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(5000, 4))
    x[:, 1] += 0.7 * x[:, 0]
    x[:, 2] = 1e8 + np.sort(x[:, 2])  # far from zero, and every task sees another part
    x[:, 3] = np.where(rng.random(5000) < 0.3, 50, 1) * x[:, 0] + x[:, 3]
    hole = rng.random((5000, 4)) < 0.2
    rows = [tuple(None if h else float(v) for v, h in zip(a, b)) for a, b in zip(x, hole)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartitionByRange(7, "c")
    got = _found(df, list("abcd"))
    for i, a in enumerate("abcd"):
        for j, b in enumerate("abcd"):
            both = ~hole[:, i] & ~hole[:, j]
            want = 1.0 if i == j else np.corrcoef(x[both, i], x[both, j])[0, 1]
            assert got[a, b] == pytest.approx(want, abs=2e-6)


def test_odd_columns(spark):
    rows = [(0.1, 1.0, None, 1.0, 3), (0.1, 2.0, None, None, 1), (0.1, 4.0, None, 1.0, 2), (0.1, None, None, 7.0, 2)]
    df = spark.createDataFrame(rows, "same double, x double, none double, pair double, whole int").repartition(3)
    got = _found(df, ["same", "x", "none", "pair", "whole"])
    assert len(got) == 25
    assert got["same", "same"] is None and got["same", "x"] is None and got["none", "none"] is None and got["none", "x"] is None
    assert got["x", "pair"] is None and got["pair", "x"] is None  # pair varies, but not where x is present
    assert got["pair", "pair"] == 1.0 and got["x", "whole"] == got["whole", "x"] == pytest.approx(np.corrcoef([1, 2, 4], [3, 1, 2])[0, 1], abs=2e-6)


def test_not_finite_and_empty(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0, nan), (2.0, 1.0, 1.0), (3.0, None, 5.0)], "a double, b double, c double")
    got = _found(df, ["a", "b", "c"])
    assert np.isnan(got["a", "c"]) and np.isnan(got["b", "c"]) and got["a", "b"] == -1.0
    assert _found(df.where("a < 0"), ["a", "b"]) == {}
