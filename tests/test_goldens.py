"""Published numbers reproduced from counts (FIXTURES.md F2)."""

import pytest

from ferrite.operators import evaluate as E
from ferrite.operators.splits import class_quotas

CASES = [  # name, FN, FP, precision, recall, f1
    ("lr", 98, 280, 0.6868, 0.8624, 0.7646),
    ("rf", 51, 112, 0.8551, 0.9284, 0.8902),
    ("hgb", 47, 79, 0.8938, 0.9340, 0.9135),
    ("mlp", 82, 194, 0.7646, 0.8848, 0.8203),
]


def test_rebuild_matrix_reproduces_published_rates(spark):
    metrics = spark.createDataFrame([(n, fn, fp) for n, fn, fp, *_ in CASES], "model STRING, fn LONG, fp LONG")
    totals = spark.createDataFrame([(712, 4097)], "n_pos LONG, n_neg LONG")
    got = {r["model"]: r for r in E.rebuild_matrix(metrics, totals, ["model"]).collect()}
    for n, fn, fp, p, r, f in CASES:
        assert round(got[n]["precision"], 4) == p
        assert round(got[n]["recall"], 4) == r
        assert round(got[n]["f1"], 4) == f
        assert got[n]["tp"] + got[n]["fn"] == 712 and got[n]["tn"] + got[n]["fp"] == 4097


def test_split_quotas_match_reference_counts(spark):
    counts = spark.createDataFrame([(0, 20482), (1, 3560)], "y INT, n_class LONG")
    q = {r["y"]: r["quota"] for r in class_quotas(counts, "y", 0.2).collect()}
    assert q == {0: 4097, 1: 712}
    inner = spark.createDataFrame([(0, 16385), (1, 2848)], "y INT, n_class LONG")
    q2 = {r["y"]: r["quota"] for r in class_quotas(inner, "y", 0.2).collect()}
    assert sum(q2.values()) == 3847 and q2[1] == 570


def test_balanced_weights(spark):
    from ferrite.operators.resample import class_weights
    rows = [(i, 1 if i < 2848 else 0) for i in range(2848 + 16385)]
    df = spark.createDataFrame(rows, "reading_id LONG, failure_within_24h INT")
    w = {r["failure_within_24h"]: r["weight"] for r in class_weights(df).collect()}
    assert w[0] == pytest.approx(0.58691, abs=1e-5) and w[1] == pytest.approx(3.37658, abs=1e-5)
