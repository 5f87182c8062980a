"""Exact Shapley values: efficiency, the linear case, and agreement with all orders."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from ferrite.operators import explain as X

COLS = ["a", "b", "c"]


def table(spark, n, shift):
    return spark.range(n).select(F.col("id").alias("reading_id"), *[
        ((F.col("id") * m + shift) % 11).cast("double").alias(c) for c, m in zip(COLS, (3, 5, 7))])


def crossed(df):
    return df.withColumn("score", F.col("a") * F.col("b") + F.when(F.col("c") > 4, F.col("a")).otherwise(F.col("c")))


def crossed_one(a, b, c):
    return a * b + (a if c > 4 else c)


def test_equals_all_orders(spark):
    rows, bg = table(spark, 6, 1), table(spark, 9, 4)
    got = {(r.reading_id, r.feature): r for r in X.shapley_exact(rows, bg, COLS, crossed).collect()}
    assert len(got) == 18
    zs = [[r[c] for c in COLS] for r in bg.collect()]
    for row in rows.collect():
        x = [row[c] for c in COLS]
        phi = [0.0] * 3
        for order in permutations(range(3)):
            for z in zs:
                mix = list(z)
                for j in order:
                    before = crossed_one(*mix)
                    mix[j] = x[j]
                    phi[j] += (crossed_one(*mix) - before) / 6 / len(zs)
        base = sum(crossed_one(*z) for z in zs) / len(zs)
        for j, c in enumerate(COLS):
            assert got[row.reading_id, c].phi == pytest.approx(phi[j], abs=1e-9)
            assert got[row.reading_id, c].base_value == pytest.approx(base, abs=1e-9)
        assert sum(phi) == pytest.approx(crossed_one(*x) - base, abs=1e-9)


def test_linear_score(spark):
    rows, bg = table(spark, 5, 2), table(spark, 7, 3)
    coef = {"a": 0.5, "b": -2.0, "c": 1.25}

    def f(df):
        return df.withColumn("score", sum(F.col(c) * w for c, w in coef.items()))

    got = {(r.reading_id, r.feature): r.phi for r in X.shapley_exact(rows, bg, COLS, f).collect()}
    for r in X.linear_contributions(rows, bg, coef).collect():
        assert got[r.reading_id, r.feature] == pytest.approx(r.phi, abs=1e-6)


def test_empty_background_and_too_many_features(spark):
    rows = table(spark, 3, 1)
    assert X.shapley_exact(rows, rows.limit(0), COLS, crossed).count() == 0
    with pytest.raises(ValueError, match="1 to 16"):
        X.shapley_exact(rows, rows, [f"x{i}" for i in range(17)], crossed)


def test_summary_of_a_feature_without_effect(spark):
    """A constant contribution (or value) has no direction; it must not end the query."""
    rows = [(i, "a", float(i), 2.0 * i) for i in range(4)] + [(i, "b", float(i), 0.0) for i in range(4)]
    rows += [(i, "c", 1.5, float(i)) for i in range(4)] + [(i, "d", None, 1.0) for i in range(4)]
    rows += [(0, "e", None, 9.0), (1, "e", 1.0, 1.0), (2, "e", 2.0, 0.0)]
    df = spark.createDataFrame(rows, "reading_id long, feature string, value double, phi double")
    got = {r.feature: (r.mean_abs_phi, r.direction) for r in X.contribution_summary(df).collect()}
    assert got == {"a": (3.0, 1.0), "b": (0.0, None), "c": (1.5, None), "d": (1.0, None), "e": (pytest.approx(10 / 3, abs=1e-6), -1.0)}
