"""Classifiers, tuning and scoring.

The four model families map onto Spark ML estimators; the reference's
hyperparameter names are translated here (``C`` -> ``regParam`` through
the training weight, ``n_estimators`` -> ``numTrees`` ...).  Tuning uses
exact stratified folds from ``splits.fold_assignment`` and runs the fits of
draws and folds concurrently; class weights, over-sampled copies and the
regularisation scale come from the rows that a fold trains on, never from
its validation rows.  Training data never passes through the driver: only
fitted parameters and per-fold metrics come back.
"""

from __future__ import annotations

import itertools
import json
import math
import random
import statistics
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrite.operators import held, networks, newton, trees
from ferrite.operators.evaluate import confusion
from ferrite.operators.resample import oversample, with_class_weights, with_copies
from ferrite.operators.splits import fold_assignment
from ferrite.schema import KEY, TARGET
from ferrite.session import materialize

# The reference's search spaces (the LR solver axis has no
# Spark twin and is dropped).
LR_SPACE = {"C": [0.01, 0.1, 1, 10, 100], "max_iter": [500, 1000, 2000]}
RF_SPACE = {"n_estimators": [100, 200, 300], "max_depth": [5, 10, 15, None],
            "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4]}
GB_SPACE = {"max_iter": [100, 200, 300], "max_depth": [3, 5, 7],
            "learning_rate": [0.05, 0.1, 0.2], "min_samples_leaf": [20, 50, 100]}
MLP_SPACE = {"units_1": [32, 64, 128], "units_2": [16, 32, 64], "dropout": [0.1, 0.2, 0.3],
             "learning_rate": [0.001, 0.005, 0.01], "batch_size": [32, 64, 128]}
# Axes without a Spark twin are left out of the draws, else equal fits would
# be drawn as different cells: RF has no split minimum, the network (l-bfgs)
# no dropout and no learning rate.
SEARCH_SPACES = {
    "lr": LR_SPACE,
    "rf": {k: v for k, v in RF_SPACE.items() if k != "min_samples_split"},
    "gbt": GB_SPACE,
    "mlp": {k: v for k, v in MLP_SPACE.items() if k not in ("dropout", "learning_rate")},
}
# Display names of the four models.
MODEL_NAMES = {"lr": "Logistic Regression", "rf": "Random Forest",
               "gbt": "Gradient Boosting", "mlp": "MLP"}

SPARK_MAX_DEPTH = 30
#: Forests of this depth or less are Spark ML's.
SHALLOW = 10
#: Families that operators.trees and operators.newton fit for many folds and draws together.
TOGETHER = ("lr", "rf", "gbt")
FEATURES = "features"
PARALLELISM = 4


def parallel_map(fn, items, parallelism: int = PARALLELISM) -> list:
    """Run independent fits concurrently from driver threads (each fit is
    its own set of distributed Spark jobs), like CrossValidator's
    ``parallelism``; results keep the input order."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


def logistic(C: float = 1.0, max_iter: int = 1000, total_weight: float = 1.0,
             weight_col: str | None = None, label: str = TARGET) -> LogisticRegression:
    """H1/H2: L2 logistic regression with sklearn's ``C``.

    sklearn minimises ``C * sum(w * loss) + |b|^2 / 2``; Spark minimises
    ``sum(w * loss) / sum(w) + regParam * |b|^2 / 2``, so
    ``regParam = 1 / (C * sum(w))``.  Balanced weights sum to n.
    """
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=label, maxIter=int(max_iter),
                            regParam=1.0 / (float(C) * float(total_weight)), elasticNetParam=0.0,
                            standardization=False, tol=1e-6)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def random_forest(n_estimators: int = 100, max_depth: int | None = None, min_samples_leaf: int = 1,
                  seed: int = 42, weight_col: str | None = None,
                  label: str = TARGET) -> RandomForestClassifier:
    """H3: depth None -> 30, Spark's deepest."""
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=int(n_estimators),
                                maxDepth=SPARK_MAX_DEPTH if max_depth is None else int(max_depth),
                                minInstancesPerNode=int(min_samples_leaf), featureSubsetStrategy="sqrt",
                                seed=seed, maxBins=64,
                                # Deep trees: split more nodes per pass over the data, and keep
                                # node ids with the rows (checkpointed to the shared folder)
                                # instead of shipping the growing trees to every task.
                                maxMemoryInMB=1024, cacheNodeIds=True, checkpointInterval=10)
    if weight_col:
        rf.setWeightCol(weight_col)
    return rf


def gradient_boosting(max_iter: int = 100, max_depth: int = 5, learning_rate: float = 0.1,
                      min_samples_leaf: int = 20, seed: int = 42, weight_col: str | None = None,
                      validation_col: str | None = None, label: str = TARGET) -> GBTClassifier:
    """H4: gradient-boosted trees; early stopping through a validation column."""
    gb = GBTClassifier(featuresCol=FEATURES, labelCol=label, maxIter=int(max_iter), maxDepth=int(max_depth),
                       stepSize=float(learning_rate), minInstancesPerNode=int(min_samples_leaf),
                       maxBins=255, seed=seed)
    if weight_col:
        gb.setWeightCol(weight_col)
    if validation_col:
        gb.setValidationIndicatorCol(validation_col)
    return gb


def mlp(input_dim: int, units_1: int = 32, units_2: int = 16, batch_size: int = 64, max_iter: int = 100,
        seed: int = 42, label: str = TARGET) -> MultilayerPerceptronClassifier:
    """H5: two hidden layers, fitted by l-bfgs over all rows.

    Spark's network has no dropout, no sample weights and, with l-bfgs, no
    step size.  ``batch_size`` sets ``blockSize``: rows stacked for one matrix
    product.  That changes the order of summation, not the objective, so it
    is not the mini-batch size of a stochastic method.  Classes are balanced
    by over-sampling (``fit``).
    """
    return MultilayerPerceptronClassifier(featuresCol=FEATURES, labelCol=label,
                                          layers=[int(input_dim), int(units_1), int(units_2), 2],
                                          blockSize=int(batch_size), maxIter=int(max_iter), seed=seed)


def make_estimator(kind: str, params: dict, input_dim: int, total_weight: float,
                   weight_col: str | None):
    if kind == "lr":
        return logistic(params.get("C", 1.0), params.get("max_iter", 1000), total_weight, weight_col)
    if kind == "rf":
        return random_forest(params.get("n_estimators", 100), params.get("max_depth"),
                             params.get("min_samples_leaf", 1), weight_col=weight_col)
    if kind == "gbt":
        return gradient_boosting(params.get("max_iter", 100), params.get("max_depth", 5),
                                 params.get("learning_rate", 0.1), params.get("min_samples_leaf", 20),
                                 weight_col=weight_col)
    if kind == "mlp":
        return mlp(input_dim, params.get("units_1", 32), params.get("units_2", 16), params.get("batch_size", 64),
                   params.get("max_iter", 100))
    raise ValueError(f"unknown model kind {kind!r}")


def failure_probability(pred: DataFrame, col: str = "score") -> DataFrame:
    """K1: P(failure) = second slot of the probability vector."""
    return pred.withColumn(col, vector_to_array(F.col("probability"))[1])


def score(model, df: DataFrame, label: str = TARGET, keep: Sequence[str] = (KEY,)) -> DataFrame:
    """K1/K2: (key, y, score) for a fitted model or pipeline."""
    p = failure_probability(model.transform(df))
    return p.select(*keep, F.col(label).alias("y"), "score")


def input_dim(df: DataFrame, features: str = FEATURES) -> int:
    return len(df.select(features).first()[0])


def sample_param_maps(space: dict, n_iter: int, seed: int = 42) -> list[dict]:
    """H6: ``n_iter`` distinct cells of the grid, drawn without replacement."""
    keys = list(space)
    cells = [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]
    rng = random.Random(seed)
    return cells if n_iter >= len(cells) else rng.sample(cells, n_iter)


def random_search(kind: str, train: DataFrame, space: dict, n_iter: int = 20, folds: int = 3,
                  seed: int = 42, balanced: bool = True, parallelism: int = PARALLELISM,
                  label: str = TARGET):
    """H6: random search with stratified k-fold CV on F1 of class 1.

    Every draw is scored on every fold by a model of the fold's own training
    rows, whose weights and regularisation are the fold's own.  Draws share
    what is equal: forests and boosters grow together in grouped passes, a
    forest serving its smaller sizes and depths and a booster its smaller
    numbers of trees (``operators.trees``); logistic fits take their steps
    together (``operators.newton``).  Returns (best
    params, table of draws with cv mean/std F1); the first draw wins ties.
    """
    draws = sample_param_maps(space, n_iter, seed)
    rows = fold_assignment(train, folds, label, seed).select(KEY, label, FEATURES, "fold")
    scored = {"lr": _logistic_draws, "rf": _forest_draws, "gbt": _boosted_draws}.get(kind)
    if scored:
        scores = scored(trees.table(rows, KEY, label, FEATURES, "fold", range(folds), balanced), draws, folds)
    else:
        scores = _fitted_draws(kind, materialize(rows), draws, folds, balanced, label, parallelism)
    f1 = {(r["draw"], r["fold"]): r["f1"] for r in confusion(scores, 0.5, ["draw", "fold"]).collect()}
    table = []
    for i, d in enumerate(draws):
        v = [f1.get((i, f), 0.0) for f in range(folds)]
        table.append((i, json.dumps(d, sort_keys=True), float(statistics.fmean(v)), float(statistics.stdev(v)) if folds > 1 else None))
    best = max(range(len(draws)), key=lambda i: (table[i][2], -i))
    return draws[best], train.sparkSession.createDataFrame(
        table, "draw INT, params STRING, cv_f1_mean DOUBLE, cv_f1_std_sample DOUBLE")


def _fitted_draws(kind: str, data: DataFrame, draws: list[dict], folds: int, balanced: bool, label: str, parallelism: int) -> DataFrame:
    """(draw, fold, y, score) by one fit for each draw and fold."""
    def one(cell):
        i, f = cell
        model = fit(kind, data.where(F.col("fold") != f), draws[i], balanced, label)
        return score(model, data.where(F.col("fold") == f), label).withColumns({"draw": F.lit(i), "fold": F.lit(f)})

    parts = parallel_map(one, [(i, f) for i in range(len(draws)) for f in range(folds)], parallelism)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _logistic_draws(t: trees.Table, draws: list[dict], folds: int) -> DataFrame:
    """(draw, fold, y, score): one fit for each C and fold.

    Newton's method ends within ``newton.PASSES`` steps, fewer than any draw
    allows, so draws that differ in the most iterations alone are one fit.
    """
    same: dict[float, list[int]] = {}
    for i, d in enumerate(draws):
        same.setdefault(float(d["C"]), []).append(i)
    fits = [newton.Fit(f * len(same) + k, f, c) for f in range(folds) for k, c in enumerate(same)]
    cells = [(f * len(same) + k, i, f) for f in range(folds) for k, mine in enumerate(same.values()) for i in mine]
    of = t.rows.sparkSession.createDataFrame(cells, "job int, draw int, fold int")  # one row for each draw and fold
    found = newton.scores(t, fits, newton.coefficients(t, fits))
    return found.join(F.broadcast(of), "job").select("draw", "fold", "y", "score")


def _forest_draws(t: trees.Table, draws: list[dict], folds: int) -> DataFrame:
    """(draw, fold, y, score): one forest for each leaf size and fold, cut to each draw's size and depth."""
    depth = [SPARK_MAX_DEPTH if d["max_depth"] is None else d["max_depth"] for d in draws]
    depths = sorted(set(depth))
    leaves = sorted({d["min_samples_leaf"] for d in draws})
    most = max(d["n_estimators"] for d in draws)
    tried = math.ceil(math.sqrt(t.n_features))
    jobs = []
    for f in range(folds):
        for k, leaf in enumerate(leaves):
            mine = [i for i, d in enumerate(draws) if d["min_samples_leaf"] == leaf]
            for tree in range(max(draws[i]["n_estimators"] for i in mine)):
                jobs.append(trees.Grown((f * len(leaves) + k) * most + tree, f, max(depth[i] for i in mine), leaf, tried, tree))
    cells = {f * len(leaves) + k: [(d["n_estimators"], depths.index(x)) for d, x in zip(draws, depth) if d["min_samples_leaf"] == leaf]
             for f in range(folds) for k, leaf in enumerate(leaves)}
    means = _forest_means(t, jobs, most, depths, cells)
    mine = [F.array(*[F.lit(i) for i, d in enumerate(draws) if d["min_samples_leaf"] == leaf]) for leaf in leaves]
    of = F.get(F.array(*mine), F.expr(f"forest % {len(leaves)}"))
    out = means.select("forest", "y", F.explode(F.arrays_zip(of.alias("draw"), F.col("scores").alias("score"))).alias("e"))
    return out.select("e.draw", F.expr(f"forest div {len(leaves)}").cast("int").alias("fold"), "y", "e.score")


def _forest_means(t: trees.Table, jobs: list[trees.Grown], most: int, depths: list[int], cells: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """``held.forest_means``, from the single votes where a task cannot hold the rows."""
    if max((t.n_train[g.fold] for g in jobs), default=0) <= held.FOREST_ROWS:
        return held.forest_means(t, jobs, most, depths, cells)
    votes = trees.forest_votes(t, jobs, depths)
    votes = votes.withColumns({"tree": F.col("job") % most, "forest": F.floor(F.col("job") / most).cast("int")})
    every = sorted({c for v in cells.values() for c in v})
    means = votes.groupBy("forest", "key", "y").agg(*[
        F.avg(F.when(F.col("tree") < n, F.col(f"vote_{d}"))).alias(f"s_{n}_{d}") for n, d in every])
    scores = F.lit(None).cast("array<double>")
    for forest, mine in cells.items():
        scores = F.when(F.col("forest") == forest, F.array(*[F.col(f"s_{n}_{d}") for n, d in mine])).otherwise(scores)
    return means.select("forest", "key", "y", scores.alias("scores"))


def _boosted_draws(t: trees.Table, draws: list[dict], folds: int) -> DataFrame:
    """(draw, fold, y, score): one booster for each depth, step, leaf size and fold, scored at each draw's number of trees."""
    same: dict[tuple, list[int]] = {}
    for i, d in enumerate(draws):
        same.setdefault((d["max_depth"], d["learning_rate"], d["min_samples_leaf"]), []).append(i)
    jobs, cells = [], []
    for f in range(folds):
        for (depth, step, leaf), mine in same.items():
            g = trees.Grown(len(jobs), f, depth, leaf, step=step, stages=tuple(sorted({draws[i]["max_iter"] for i in mine})))
            jobs.append(g)
            cells += [(g.id, draws[i]["max_iter"], i, f) for i in mine]
    # one row for each draw and fold
    of = t.rows.sparkSession.createDataFrame(cells, "job int, stage int, draw int, fold int")
    return trees.boosted_scores(t, jobs).join(F.broadcast(of), ["job", "stage"]).select("draw", "fold", "y", "score")


def fit(kind: str, train: DataFrame, params: dict | None = None, balanced: bool = True,
        label: str = TARGET):
    """Fit one model on prepared rows (``features`` + label).

    ``balanced``: class weights from these rows; for the network, which takes
    no weights, whole copies of the smaller classes' rows (F5).  A forest deeper
    than ``SHALLOW`` is a ``GrownForest``: Spark ML sends a histogram of each
    node from each task, and such a forest has more nodes than rows in them.
    """
    params = dict(params or {})
    early = params.pop("validation_fraction", None)
    data, wcol = train, None
    if kind == "rf" and (params.get("max_depth") is None or params["max_depth"] > SHALLOW):
        return GrownForest.fitted(train, params, balanced, label)
    if balanced and kind == "mlp":
        data = materialize(oversample(train.select(KEY, label, FEATURES), label))
    elif balanced:
        data, wcol = with_class_weights(train, label, "weight"), "weight"
    total = data.count() if kind == "lr" else 1.0
    dim = input_dim(data) if kind == "mlp" else 0
    est = make_estimator(kind, params, dim, total, wcol)
    if early and kind == "gbt":
        # a stratified held-out share stops boosting once the validation
        # loss stops improving (Spark's validationTol).
        from ferrite.operators.splits import validation_indicator
        data = materialize(validation_indicator(data, float(early), label, col="is_validation"))
        est.setValidationIndicatorCol("is_validation")
    return est.fit(data)


class GrownForest(Model):
    """H3: a forest of ``operators.trees`` behind Spark ML's interface: ``probability`` and ``prediction``."""

    def __init__(self, forest: trees.Forest):
        super().__init__()
        self.forest = forest

    @classmethod
    def fitted(cls, train: DataFrame, params: dict, balanced: bool = True, label: str = TARGET) -> GrownForest:
        rows = train.select(KEY, label, FEATURES, F.lit(0).alias("fold"))
        t = trees.table(rows, KEY, label, FEATURES, "fold", [1], balanced)
        depth = SPARK_MAX_DEPTH if params.get("max_depth") is None else int(params["max_depth"])
        n = int(params.get("n_estimators", 100))
        jobs = [trees.Grown(i, 1, depth, int(params.get("min_samples_leaf", 1)), math.ceil(math.sqrt(t.n_features)), i) for i in range(n)]
        return cls(trees.forest(t, jobs))

    def _transform(self, df: DataFrame) -> DataFrame:
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "forest-rows")
        found = trees.forest_scores(self.forest, rows.select(F.col("_row").alias("_key"), vector_to_array(FEATURES).alias("_x")))
        s = F.col("score")
        found = found.select(F.col("key").alias("_row"), array_to_vector(F.array(1 - s, s)).alias("probability"),
                             (s > 0.5).cast("double").alias("prediction"))
        return rows.join(found, "_row").drop("_row")


class GrownBooster(Model):
    """H4: a booster of ``operators.held`` behind Spark ML's interface: ``probability`` and ``prediction``."""

    def __init__(self, grown: list[trees.Tree], job: trees.Grown, edges: list):
        super().__init__()
        self.grown, self.job, self.edges = grown, job, edges

    @classmethod
    def fitted(cls, t: trees.Table, params: dict) -> GrownBooster:
        n = int(params.get("max_iter", 100))
        job = trees.Grown(0, 1, int(params.get("max_depth", 5)), int(params.get("min_samples_leaf", 20)),
                          step=float(params.get("learning_rate", 0.1)), stages=(n,))
        return cls(held.booster_trees(t, job), job, t.edges[1])

    def _transform(self, df: DataFrame) -> DataFrame:
        sent = df.sparkSession.sparkContext.broadcast((self.grown, self.job, self.edges))

        @F.pandas_udf("double")
        def p(x: pd.Series) -> pd.Series:
            grown, job, edges = sent.value
            bins = trees.binned(np.stack(x.to_numpy()), edges) if len(x) else np.zeros((0, len(edges)), np.uint8)
            return pd.Series(trees.probability(held.booster_margin(grown, job, bins)))

        s = F.col("_p")
        out = df.withColumn("_p", p(vector_to_array(FEATURES)))
        return out.withColumns({"probability": array_to_vector(F.array(1 - s, s)), "prediction": (s > 0.5).cast("double")}).drop("_p")


def fit_to_score(kind: str, train: DataFrame, params: dict | None = None, balanced: bool = True, label: str = TARGET):
    """``fit`` of a model that is not saved: a booster grows in a task that holds the rows, where one can."""
    params = dict(params or {})
    if kind == "gbt" and not params.get("validation_fraction"):
        t = trees.table(train.select(KEY, label, FEATURES, F.lit(0).alias("fold")), KEY, label, FEATURES, "fold", [1], balanced)
        if t.n_train[1] <= held.BOOSTER_ROWS:
            return GrownBooster.fitted(t, params)
    return fit(kind, train, params, balanced, label)


def cross_validated_scores(kind: str, train: DataFrame, params: dict | None = None, k: int = 5,
                           seed: int = 42, balanced: bool = True, label: str = TARGET) -> DataFrame:
    """H8: out-of-fold scores (key, fold, y, score); weights recomputed per fold.

    The models of all folds are fitted in the same passes (``operators.trees``,
    ``operators.newton``, ``operators.networks``).
    """
    rows = fold_assignment(train, k, label, seed)
    if kind in TOGETHER:
        t = trees.table(rows, KEY, label, FEATURES, "fold", range(k), balanced)
        return _grown_scores(kind, t, params or {}, range(k)).select(F.col("key").alias(KEY), "fold", "y", "score")
    if kind == "mlp":
        return _network_scores(rows, params or {}, range(k), balanced, label)
    data = materialize(rows)

    def one(f):
        model = fit(kind, data.where(F.col("fold") != f), params, balanced, label)
        return score(model, data.where(F.col("fold") == f), label, keep=(KEY, "fold"))

    parts = parallel_map(one, range(k))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fitted_scores(kind: str, train: DataFrame, held: DataFrame, params: dict | None = None,
                  balanced: bool = True, label: str = TARGET) -> DataFrame:
    """K1: (key, y, score) of ``held`` by a model of ``train``, where the model itself is not wanted."""
    if kind not in (*TOGETHER, "mlp"):
        return score(fit(kind, train, params, balanced, label), held, label)
    both = train.select(KEY, label, FEATURES, F.lit(0).alias("fold")).unionByName(held.select(KEY, label, FEATURES, F.lit(1).alias("fold")))
    if kind == "mlp":
        return _network_scores(both, params or {}, [1], balanced, label).drop("fold")
    t = trees.table(both, KEY, label, FEATURES, "fold", [1], balanced)
    return _grown_scores(kind, t, params or {}, [1]).select(F.col("key").alias(KEY), "y", "score")


def _grown_scores(kind: str, t: trees.Table, params: dict, folds: Sequence[int]) -> DataFrame:
    """(key, fold, y, score) of the rows of each of ``folds``, by a model of the other rows."""
    if kind == "lr":
        fits = [newton.Fit(f, f, float(params.get("C", 1.0))) for f in folds]
        return newton.scores(t, fits, newton.coefficients(t, fits)).select("key", "y", F.col("job").alias("fold"), "score")
    if kind == "rf":
        depth = SPARK_MAX_DEPTH if params.get("max_depth") is None else params["max_depth"]
        n = params.get("n_estimators", 100)
        jobs = [trees.Grown(f * n + i, f, depth, params.get("min_samples_leaf", 1), math.ceil(math.sqrt(t.n_features)), i)
                for f in folds for i in range(n)]
        means = _forest_means(t, jobs, n, [depth], {f: [(n, 0)] for f in folds})
        # written: a forest is not grown again for every reader of its scores
        return materialize(means.select("key", "y", F.col("forest").alias("fold"), F.col("scores")[0].alias("score")), "forest-scores")
    n = params.get("max_iter", 100)
    jobs = [trees.Grown(f, f, params.get("max_depth", 5), params.get("min_samples_leaf", 20), step=params.get("learning_rate", 0.1), stages=(n,))
            for f in folds]
    return trees.boosted_scores(t, jobs).select("key", "y", F.col("job").alias("fold"), "score")


def _network_scores(rows: DataFrame, params: dict, folds: Sequence[int], balanced: bool, label: str) -> DataFrame:
    """(key, fold, y, score) of the rows of each of ``folds``, by a network of the other rows, all fitted in the same passes."""
    rows = data = materialize(rows.select(KEY, label, FEATURES, "fold"))
    for f in folds:
        others = F.col("fold") != f
        data = with_copies(data, label, copies_col=f"copies_{f}", among=others) if balanced else data.withColumn(f"copies_{f}", others.cast("int"))
    layers = (input_dim(rows), int(params.get("units_1", 32)), int(params.get("units_2", 16)), 2)
    fits = [networks.Fit(f, layers, int(params.get("max_iter", 100)), place=i) for i, f in enumerate(folds)]
    found = networks.weights(networks.packed(data, KEY, label, FEATURES, [f"copies_{f}" for f in folds]), fits)
    return networks.scores(rows, label, FEATURES, fits, found, KEY, "fold").select(KEY, F.col("job").alias("fold"), "y", "score")


def training_history(model) -> DataFrame | None:
    """Objective per iteration; None for models that keep none (trees)."""
    if not getattr(model, "hasSummary", False):
        return None
    summary = model.summary() if callable(model.summary) else model.summary
    if not hasattr(summary, "objectiveHistory"):
        return None
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession().createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(summary.objectiveHistory)], "epoch INT, loss DOUBLE")


def scoring_pipeline(preprocessor: PipelineModel, classifier) -> PipelineModel:
    """One PipelineModel from raw readings to probabilities (K3/K5/K6)."""
    return PipelineModel(stages=[*preprocessor.stages, classifier])


def search_on_validation(kind: str, fit_rows: DataFrame, val_rows: DataFrame, space: dict,
                         n_iter: int = 10, seed: int = 42, balanced: bool = True,
                         label: str = TARGET):
    """H7: random search scored on one fixed validation part (first best on ties).

    Networks are fitted together (``operators.networks``); draws of other
    kinds concurrently, each by ``fit``.  All are scored on the validation rows
    in one grouped job.
    """
    draws = sample_param_maps(space, n_iter, seed)
    if kind == "mlp":
        scores = _network_draws(fit_rows, val_rows, draws, balanced, label)
    else:
        def one(i):
            model = fit(kind, fit_rows, draws[i], balanced, label)
            return score(model, val_rows, label).withColumn("draw", F.lit(i))

        parts = parallel_map(one, range(len(draws)))
        scores = parts[0]
        for p in parts[1:]:
            scores = scores.unionByName(p)
    f1 = confusion(scores, 0.5, ["draw"]).select("draw", F.round("f1", 6).alias("validation_f1"))
    table = materialize(train_rows_params(fit_rows.sparkSession, draws).join(f1, "draw"))
    best_row = table.orderBy(F.col("validation_f1").desc(), F.col("draw").asc()).first()
    return draws[best_row["draw"]], table


def _network_draws(fit_rows: DataFrame, val_rows: DataFrame, draws: list[dict], balanced: bool, label: str) -> DataFrame:
    """(draw, y, score) of the validation rows: one network for each pair of hidden layers.

    ``batch_size`` is the rows of a matrix product (``mlp``), not a part of
    the objective: draws that differ in it alone are one fit.
    """
    rows = fit_rows.select(KEY, label, FEATURES)
    rows = with_copies(rows, label) if balanced else rows.withColumn("copies", F.lit(1))
    dim, same = input_dim(rows), {}
    for i, d in enumerate(draws):
        layers = (dim, int(d.get("units_1", 32)), int(d.get("units_2", 16)), 2)
        same.setdefault((layers, int(d.get("max_iter", 100))), []).append(i)
    fits = [networks.Fit(k, layers, most) for k, (layers, most) in enumerate(same)]
    found = networks.weights(networks.packed(rows, KEY, label, FEATURES, "copies"), fits)
    of = rows.sparkSession.createDataFrame([(k, i) for k, mine in enumerate(same.values()) for i in mine], "job int, draw int")
    return networks.scores(val_rows, label, FEATURES, fits, found).join(F.broadcast(of), "job").select("draw", "y", "score")


def train_rows_params(spark, draws: list[dict]) -> DataFrame:
    return spark.createDataFrame([(i, json.dumps(d, sort_keys=True)) for i, d in enumerate(draws)],
                                 "draw INT, params STRING")
