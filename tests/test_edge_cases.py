"""Hand-sized edge cases (FIXTURES.md F3)."""

import pytest
from pyspark.sql import functions as F

from ferrite.operators import evaluate as E
from ferrite.operators import prepare as G
from ferrite.operators import profile as P
from ferrite.operators.ordered import exact_quantiles


def test_even_count_median_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x DOUBLE")
    q = exact_quantiles(P.long_values(df, ["x"]), ["column_name"], "value", [0.5]).first()
    assert q["q_0"] == 2.5


def test_quantiles_match_percentile(spark):
    rows = [(float(v % 37) * 1.5,) for v in range(1, 500)]
    df = spark.createDataFrame(rows, "x DOUBLE")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    mine = exact_quantiles(P.long_values(df, ["x"]), ["column_name"], "value", probs).first()
    ref = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in probs])).alias("p")).first()["p"]
    for i, v in enumerate(ref):
        assert mine[f"q_{i}"] == pytest.approx(v, abs=1e-12)


def test_scaler_uses_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x DOUBLE")
    m = G.MedianStandardScaler(inputCols=["x"], outputCols=["z"]).fit(df)
    assert m.getStds()[0] == pytest.approx(3.5355339, abs=1e-6)
    assert m.getMedians()[0] == 2.5


def test_unseen_and_null_category_encode_to_zeros(spark):
    train = spark.createDataFrame([(1, "CNC", "idle", 1.0), (2, "Pump", "peak", 2.0), (3, "Arm", "normal", 3.0)],
                                  "reading_id INT, machine_type STRING, operating_mode STRING, x DOUBLE")
    test = spark.createDataFrame([(4, "ZZZ", "idle", 1.0), (5, None, "idle", 1.0)],
                                 "reading_id INT, machine_type STRING, operating_mode STRING, x DOUBLE")
    model = G.build_preprocessor(["x"], ["machine_type", "operating_mode"]).fit(train)
    names = G.feature_names(model, ["x"], ["machine_type", "operating_mode"])
    assert names == ["num__x", "cat__machine_type_Arm", "cat__machine_type_CNC", "cat__machine_type_Pump",
                     "cat__operating_mode_idle", "cat__operating_mode_normal", "cat__operating_mode_peak"]
    out = G.with_named_features(model.transform(test), names).collect()
    for r in out:
        assert [r[n] for n in names[1:4]] == [0.0, 0.0, 0.0]
        assert r["cat__operating_mode_idle"] == 1.0


TIED = [(0.9, 1), (0.8, 0), (0.8, 1), (0.6, 1), (0.5, 0), (0.4, 1), (0.3, 0), (0.1, 0)]


def test_auc_and_ap_with_ties(spark):
    df = spark.createDataFrame(TIED, "score DOUBLE, y INT")
    r = E.auc_ap(df).first()
    assert r["roc_auc"] == pytest.approx(0.78125)
    assert r["average_precision"] == pytest.approx(0.770833, abs=1e-6)


def test_curves_end_points(spark):
    df = spark.createDataFrame(TIED, "score DOUBLE, y INT")
    roc = {(r["fpr"], r["tpr"]) for r in E.roc_curve(df).collect()}
    assert (0.0, 0.0) in roc and (1.0, 1.0) in roc
    pr = E.pr_curve(df).collect()
    assert any(r["threshold"] is None and r["precision"] == 1.0 and r["recall"] == 0.0 for r in pr)


def test_no_predicted_positive(spark):
    df = spark.createDataFrame(TIED, "score DOUBLE, y INT")
    r = E.confusion(df, 0.95).first()
    assert r["precision"] == 0.0 and r["f1"] == 0.0 and r["tp"] == 0


def test_tied_best_f1_takes_lower_threshold(spark):
    sweep = spark.createDataFrame([(0.3, 0.5, 1.0, 0.6, 0, 3), (0.5, 0.6, 0.6, 0.6, 2, 1), (0.7, 0.4, 0.2, 0.3, 4, 0)],
                                  "threshold DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE, fn LONG, fp LONG")
    assert E.best_threshold(sweep).first()["threshold"] == 0.3


def test_sweep_matches_brute_force(spark):
    df = spark.createDataFrame(TIED + [(0.05, 1), (0.95, 0), (0.7, 1)], "score DOUBLE, y INT")
    sweep = {r["threshold"]: r for r in E.threshold_sweep(df).collect()}
    for t, r in sweep.items():
        tp = sum(1 for s, y in TIED + [(0.05, 1), (0.95, 0), (0.7, 1)] if s >= t and y == 1)
        fp = sum(1 for s, y in TIED + [(0.05, 1), (0.95, 0), (0.7, 1)] if s >= t and y == 0)
        assert r["fp"] == fp
        assert r["precision"] == pytest.approx(round(tp / (tp + fp), 6) if tp + fp else 0.0)


def test_histogram_max_goes_to_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x DOUBLE")
    h = {r["bin"]: r["n"] for r in P.histogram(df, ["x"], 5).collect()}
    assert h == {1: 1, 2: 0, 3: 1, 4: 0, 5: 1}


def test_correlation_pairwise_deletion(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (4.0, 9.0)], "a DOUBLE, b DOUBLE")
    r = {(x["col_a"], x["col_b"]): x["r"] for x in P.correlation_matrix(df, ["a", "b"]).collect()}
    assert r[("a", "b")] == pytest.approx(0.963123, abs=1e-6)
    assert r[("a", "a")] == 1.0


def test_duplicates_with_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "a INT, b INT")
    assert P.duplicate_rows(df, ["a", "b"]).first()["n_duplicates"] == 1


def test_padded_csv(spark, tmp_path):
    p = tmp_path / "padded.csv"
    p.write_text("model       , seuil, f1\nLR          , 0.60, 0.7646\nHGB         , 0.70, 0.9135\n")
    from ferrite.sources.files import model_threshold, read_result_csv
    df = read_result_csv(spark, str(p))
    assert df.columns == ["model", "seuil", "f1"]
    assert dict(df.dtypes)["f1"] == "double"
    assert model_threshold(df, "HGB", threshold_col="seuil") == 0.70
    assert model_threshold(df, "nope", threshold_col="seuil") == 0.70
