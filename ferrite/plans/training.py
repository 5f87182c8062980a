"""Model comparison plans.

Each plan fits models on the written prepared table, scores the held-out
rows into one long table (key, model, y, score) and evaluates all models
in one grouped job with the exact evaluators.  Only fitted parameters,
timings and the small metric tables reach the driver.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrite.operators import evaluate as E
from ferrite.operators import models as M
from ferrite.operators import resample as R
from ferrite.operators.splits import stratified_split
from ferrite.plans.preparation import Prepared
from ferrite.schema import KEY, TARGET
from ferrite.session import materialize
from ferrite.sources import files


def _union(dfs: Sequence[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def test_metrics(scores: DataFrame, group: str = "model", threshold=0.5) -> DataFrame:
    """Recall, F1, ROC-AUC, PR-AUC, FN, FP per group at a threshold."""
    c = E.confusion(scores, threshold, [group], digits=6)
    return c.join(E.auc_ap(scores, [group]), group).select(
        group, "recall", "f1", "precision", F.col("roc_auc"), F.col("average_precision").alias("pr_auc"),
        "fn", "fp")


def rebalancing_comparison(prep: Prepared, seed: int = 42, with_smote: bool = True) -> DataFrame:
    """H9: one LR per rebalancing technique, test metrics at 0.5."""
    train, test = prep.part("train"), prep.part("test")
    variants = {
        "none": (train, False),
        "class_weight": (train, True),
        "over_sampling": (R.oversample(train, TARGET, seed).drop("copy"), False),
        "under_sampling": (R.undersample(train, TARGET, seed), False),
    }
    if with_smote:
        variants["smote"] = (materialize(R.smote(train.select(KEY, TARGET, "features"), TARGET,
                                                 seed=seed)), False)
    def one(item):
        name, (data, balanced) = item
        model = M.fit("lr", data, {"C": 1.0, "max_iter": 1000}, balanced=balanced)
        return M.score(model, test).withColumn("technique", F.lit(name))

    return test_metrics(_union(M.parallel_map(one, list(variants.items()))), "technique")


def stability(prep: Prepared, kinds: Sequence[str], params: dict | None = None, k: int = 5,
              seed: int = 42) -> DataFrame:
    """K-fold F1 mean and population std per model."""
    params = params or {}
    parts = [M.cross_validated_scores(kind, prep.part("train"), params.get(kind), k, seed).withColumn("model", F.lit(kind))
             for kind in kinds]
    per_fold = E.confusion(_union(parts), 0.5, ["model", "fold"])
    return E.fold_summary(per_fold, ["model"], "f1")


def fit_all(prep: Prepared, kinds: Sequence[str], params: dict | None = None,
            part: DataFrame | None = None):
    """Fit each model on the training rows (or ``part``); return models and timings."""
    params = params or {}
    data = part if part is not None else prep.part("train")

    def one(kind):
        t0 = time.time()
        m = M.fit_to_score(kind, data, params.get(kind))
        return m, time.time() - t0

    res = M.parallel_map(one, kinds)
    return ({k: r[0] for k, r in zip(kinds, res)}, {k: r[1] for k, r in zip(kinds, res)})


def score_all(models: dict, rows: DataFrame) -> DataFrame:
    return _union([M.score(m, rows).withColumn("model", F.lit(k)) for k, m in models.items()])


def search_draws(prep: Prepared, kind: str, n_iter: int, seed: int = 42) -> DataFrame:
    """H6/H7: the table of draws of one kind, the best first.

    The network is scored on one validation part, the others on three folds.
    """
    train = prep.part("train").drop("split")
    if kind == "mlp":
        fv = materialize(stratified_split(train, TARGET, 0.2, seed, split_col="part", names=("fit", "validation")))
        _, found = M.search_on_validation(kind, fv.where(F.col("part") == "fit"), fv.where(F.col("part") == "validation"),
                                          M.SEARCH_SPACES[kind], n_iter, seed)
        return found.orderBy(F.col("validation_f1").desc(), "draw")
    _, found = M.random_search(kind, train, M.SEARCH_SPACES[kind], n_iter, 3, seed)
    return found.orderBy(F.col("cv_f1_mean").desc(), "draw")


def tuned_params(draws: dict[str, DataFrame], defaults: dict) -> dict:
    """The best parameters of each kind over its defaults.

    ``draws`` has result tables of searches (``validation_f1`` or
    ``cv_f1_mean``); kinds without one keep their defaults.
    """
    out = {}
    for kind, default in defaults.items():
        table = draws.get(kind)
        if table is not None:
            by = "validation_f1" if "validation_f1" in table.columns else "cv_f1_mean"
            table = table.orderBy(F.col(by).desc(), "draw")
        out[kind] = files.best_params(table, default)
    return out


def display_name(model: str = "model"):
    """The model's display name; names without one stay as they are."""
    out = F.col(model)
    for kind, name in M.MODEL_NAMES.items():
        out = F.when(F.col(model) == kind, F.lit(name)).otherwise(out)
    return out


def compare_models(prep: Prepared, kinds: Sequence[str], params: dict | None = None,
                   folds: int = 5) -> DataFrame:
    """Display name, stability, train time and test metrics at 0.5 per model."""
    models, times = fit_all(prep, kinds, params)
    # written: a forest is not asked again for each metric
    m = test_metrics(materialize(score_all(models, prep.part("test"))))
    spark = prep.rows.sparkSession
    t = spark.createDataFrame([(k, float(v)) for k, v in times.items()], "model STRING, train_time_s DOUBLE")
    out = m.join(t, "model", "left").withColumn("name", display_name())
    if folds:
        out = out.join(stability(prep, kinds, params, folds), "model", "left")
    return out


def threshold_tuning(prep: Prepared, kinds: Sequence[str], params: dict | None = None,
                     seed: int = 42, full_models: dict | None = None) -> DataFrame:
    """Threshold chosen on a validation part of train, applied on test.

    Models refitted on the fit part score the validation rows; the sweep
    picks the best F1 (lowest threshold on ties); the full-train models
    are then evaluated on test at 0.5 and at the chosen threshold.
    """
    train, test = prep.part("train"), prep.part("test")
    fv = materialize(stratified_split(train.drop("split"), TARGET, 0.2, seed, split_col="part",
                                      names=("fit", "validation")))
    def scored(rows, held):
        return _union(M.parallel_map(lambda k: M.fitted_scores(k, rows, held, (params or {}).get(k)).withColumn("model", F.lit(k)), kinds))

    val_scores = scored(fv.where(F.col("part") == "fit"), fv.where(F.col("part") == "validation"))
    best = E.best_threshold(E.threshold_sweep(val_scores, ["model"]), ["model"])
    test_scores = materialize(score_all(full_models, test) if full_models is not None else scored(train, test))
    at_t = E.metrics_at(test_scores, best, ["model"], with_areas=True)
    at_d = E.confusion(test_scores, 0.5, ["model"], digits=6)
    b = best.select("model", F.col("threshold").alias("selected_threshold"),
                    *[F.col(c).alias(f"validation_{c}") for c in ("precision", "recall", "f1", "fn", "fp")])
    d = at_d.select("model", F.col("f1").alias("test_f1_default"), F.col("fn").alias("test_fn_default"),
                    F.col("fp").alias("test_fp_default"))
    t = at_t.select("model", *[F.col(c).alias(f"test_{c}") for c in
                               ("precision", "recall", "f1", "fn", "fp", "roc_auc", "average_precision")])
    return b.join(d, "model").join(t, "model")


def final_selection(tuning: DataFrame, override: str | None = None, stability_table: DataFrame | None = None) -> DataFrame:
    """Rank by test F1 then recall; ``override`` forces the winner.

    ``stability_table`` (one row per model) is joined on the left, so a model
    without folds keeps its row.
    """
    table = tuning.withColumnRenamed("test_f1", "f1").withColumnRenamed("test_recall", "recall")
    ranked = E.rank_models(table, ("f1", "recall"))
    sel = (F.col("model") == F.lit(override)) if override else (F.col("rank") == 1)
    out = ranked.withColumn("selected", sel).withColumnRenamed("f1", "test_f1") \
                .withColumnRenamed("recall", "test_recall").withColumn("name", display_name())
    return out.join(stability_table, "model", "left") if stability_table is not None else out
