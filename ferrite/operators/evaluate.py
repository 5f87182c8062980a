"""Exact binary-classification evaluation.

Input is a long score table: optional group columns (model, fold, ...),
a 0/1 label and a score.  Nothing is collected: confusion counts are one
aggregate, the threshold sweep is one aggregate into at most 20 buckets
per group, and ROC-AUC / average precision are exact (ties grouped) via
running totals over distinct scores (``ordered.running_totals``), never
a single-task window over all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrite.functions import attach_one_row, decide, ratio
from ferrite.operators.ordered import running_totals

# The sweep grid 0.05, 0.10, ..., 0.95 (stored rounded).
SWEEP = [round(0.05 * j, 2) for j in range(1, 20)]


def _zero_div(num: Column, den: Column) -> Column:
    return F.coalesce(ratio(num, den), F.lit(0.0))


def rates(tp: Column, fp: Column, fn: Column, tn: Column, digits: int | None = None) -> list[Column]:
    """E2-E5 from confusion counts; 0 where a denominator is 0."""
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return [
        r(ratio(tp + tn, tp + fp + fn + tn)).alias("accuracy"),
        r(_zero_div(tp, tp + fp)).alias("precision"),
        r(_zero_div(tp, tp + fn)).alias("recall"),
        r(_zero_div(2 * tp, 2 * tp + fp + fn)).alias("f1"),
    ]


def confusion(scores: DataFrame, threshold=0.5, groups: Sequence[str] = (), label: str = "y",
              score: str = "score", digits: int | None = None) -> DataFrame:
    """Counts and rates at a threshold (a number or a column)."""
    pred = decide(F.col(score), threshold if isinstance(threshold, Column) else float(threshold))
    y = F.col(label)
    a = scores.groupBy(*groups).agg(
        F.count_if((y == 0) & (pred == 0)).alias("tn"), F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"), F.count_if((y == 1) & (pred == 1)).alias("tp"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return a.select(*groups, "tn", "fp", "fn", "tp", *rates(tp, fp, fn, tn, digits))


def classification_report(scores: DataFrame, threshold=0.5, label: str = "y",
                          score: str = "score") -> DataFrame:
    """Per-class precision/recall/F1/support, accuracy, macro and weighted means."""
    c = confusion(scores, threshold, (), label, score)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    row = lambda name, p, r, f, s: F.struct(
        F.lit(name).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
        s.cast("bigint").alias("support"))
    p1, r1, f1 = _zero_div(tp, tp + fp), _zero_div(tp, tp + fn), _zero_div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _zero_div(tn, tn + fn), _zero_div(tn, tn + fp), _zero_div(2 * tn, 2 * tn + fp + fn)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = ratio(tp + tn, n)
    w = lambda a, b: (a * s0 + b * s1) / n
    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", w(p0, p1), w(r0, r1), w(f0, f1), n))
    out = c.select(F.explode(rows).alias("r")).select("r.*")
    return out.select("label", *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1")], "support")


def score_table(scores: DataFrame, groups: Sequence[str] = (), label: str = "y",
                score: str = "score") -> DataFrame:
    """Distinct scores per group with their positive/negative counts and
    the inclusive running counts in descending score order."""
    y = F.col(label)
    d = scores.groupBy(*groups, score).agg(F.count_if(y == 1).cast("bigint").alias("tp"),
                                          F.count_if(y == 0).cast("bigint").alias("fp"))
    cum, tot = running_totals(d, groups, [F.col(score).desc()], ["tp", "fp"], return_totals=True)
    tot = tot.withColumnRenamed("tp", "n_pos").withColumnRenamed("fp", "n_neg")
    # One row per group: bounded by the number of groups.
    return cum.join(F.broadcast(tot), list(groups)) if groups else attach_one_row(cum, tot)


def auc_ap(scores: DataFrame, groups: Sequence[str] = (), label: str = "y",
           score: str = "score") -> DataFrame:
    """Exact ROC-AUC (trapezoid, ties as one step) and average
    precision (step sum, sklearn's definition) per group."""
    t = score_table(scores, groups, label, score)
    ctp, cfp = F.col("cum_tp"), F.col("cum_fp")
    area = F.col("fp").cast("double") * (2 * ctp - F.col("tp")).cast("double")
    ap_term = F.col("tp").cast("double") * ratio(ctp, ctp + cfp)
    a = t.groupBy(*groups).agg(
        F.sum(area).alias("_area"), F.sum(ap_term).alias("_ap"),
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"))
    return a.select(*groups, F.round(ratio(F.col("_area"), 2 * F.col("n_pos") * F.col("n_neg")), 6).alias("roc_auc"),
                    F.round(ratio(F.col("_ap"), F.col("n_pos")), 6).alias("average_precision"))


def roc_curve(scores: DataFrame, groups: Sequence[str] = (), label: str = "y",
              score: str = "score") -> DataFrame:
    """One point per distinct score plus the origin (threshold NULL)."""
    t = score_table(scores, groups, label, score)
    pts = t.select(*groups, F.col(score).alias("threshold"),
                   F.round(ratio(F.col("cum_fp"), F.col("n_neg")), 6).alias("fpr"),
                   F.round(ratio(F.col("cum_tp"), F.col("n_pos")), 6).alias("tpr"))
    origin = t.select(*groups).distinct().select(*groups, F.lit(None).cast("double").alias("threshold"),
                                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(origin)


def pr_curve(scores: DataFrame, groups: Sequence[str] = (), label: str = "y",
             score: str = "score") -> DataFrame:
    """(precision, recall) per distinct score plus the end point (1, 0)."""
    t = score_table(scores, groups, label, score)
    pts = t.select(*groups, F.col(score).alias("threshold"),
                   F.round(ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp")), 6).alias("precision"),
                   F.round(ratio(F.col("cum_tp"), F.col("n_pos")), 6).alias("recall"))
    end = t.select(*groups).distinct().select(*groups, F.lit(None).cast("double").alias("threshold"),
                                              F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def threshold_sweep(scores: DataFrame, groups: Sequence[str] = (), label: str = "y",
                    score: str = "score", thresholds: Sequence[float] = SWEEP) -> DataFrame:
    """Precision, recall, F1, FN, FP at each grid threshold, one pass.

    Each row goes to bucket b = number of thresholds <= score; counts by
    (group, bucket, label) are at most (len(grid)+1) x 2 rows per group,
    and the counts at threshold j are a reverse running sum over them.
    """
    if not groups:
        out = threshold_sweep(scores.withColumn("_all", F.lit(0)), ["_all"], label, score, thresholds)
        return out.drop("_all")
    s, y = F.col(score), F.col(label)
    bucket = sum(((s >= F.lit(float(t))).cast("int") for t in thresholds), F.lit(0))
    b = scores.groupBy(*groups, bucket.alias("b")).agg(
        F.count_if(y == 1).cast("bigint").alias("pos"), F.count_if(y == 0).cast("bigint").alias("neg"))
    grid = F.array(*[F.struct(F.lit(j + 1).alias("j"), F.lit(float(t)).alias("threshold"))
                     for j, t in enumerate(thresholds)])
    full = b.select(*groups).distinct().select(*groups, F.explode(grid).alias("_t")).select(
        *groups, "_t.j", "_t.threshold")
    # tp(j) = positives in buckets >= j; fp likewise.
    j = full.join(b, list(groups), "left").groupBy(*groups, "j", "threshold").agg(
        F.sum(F.when(F.col("b") >= F.col("j"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("b") >= F.col("j"), F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.col("pos")).alias("_p"), F.sum(F.col("neg")).alias("_n"))
    tp, fp = F.col("tp").cast("bigint"), F.col("fp").cast("bigint")
    fn, tn = (F.col("_p") - tp).cast("bigint"), (F.col("_n") - fp).cast("bigint")
    return j.select(*groups, "threshold",
                    F.round(_zero_div(tp, tp + fp), 6).alias("precision"),
                    F.round(_zero_div(tp, tp + fn), 6).alias("recall"),
                    F.round(_zero_div(2 * tp, 2 * tp + fp + fn), 6).alias("f1"),
                    fn.alias("fn"), fp.alias("fp"))


def best_threshold(sweep: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The row of maximal F1; on ties the lowest threshold."""
    key = F.struct(F.col("f1"), (-F.col("threshold")).alias("neg_t"))
    best = sweep.groupBy(*groups).agg(F.max_by(F.struct(*[c for c in sweep.columns if c not in groups]),
                                               key).alias("b"))
    return best.select(*groups, "b.*")


def metrics_at(scores: DataFrame, thresholds: DataFrame, groups: Sequence[str], label: str = "y",
               score: str = "score", with_areas: bool = True) -> DataFrame:
    """Confusion + rates (+ ROC-AUC/AP) at a per-group threshold.

    ``thresholds`` has one row per group (columns groups + threshold) and
    is broadcast (bounded by the number of groups).
    """
    j = scores.join(F.broadcast(thresholds.select(*groups, "threshold")), list(groups))
    c = confusion(j, F.col("threshold"), [*groups, "threshold"], label, score, digits=6)
    if with_areas:
        c = c.join(auc_ap(scores, groups, label, score), list(groups))
    return c


def rebuild_matrix(metrics: DataFrame, totals: DataFrame, groups: Sequence[str]) -> DataFrame:
    """TN/FP/FN/TP and rates from FN, FP and the class totals."""
    j = attach_one_row(metrics, totals.select("n_pos", "n_neg"))
    tp = (F.col("n_pos") - F.col("fn")).cast("bigint")
    tn = (F.col("n_neg") - F.col("fp")).cast("bigint")
    fp, fn = F.col("fp").cast("bigint"), F.col("fn").cast("bigint")
    return j.select(*groups, tn.alias("tn"), fp.alias("fp"), fn.alias("fn"), tp.alias("tp"),
                    *rates(tp, fp, fn, tn, digits=6))


def fold_summary(fold_metrics: DataFrame, groups: Sequence[str], metric: str = "f1") -> DataFrame:
    """Mean and population std of a metric over folds."""
    return fold_metrics.groupBy(*groups).agg(
        F.round(F.avg(metric), 6).alias(f"cv_{metric}_mean"),
        F.round(F.stddev_pop(metric), 6).alias(f"cv_{metric}_std"),
        F.count(F.lit(1)).alias("n_folds"))


def rank_models(table: DataFrame, by=("f1", "recall"), col: str = "rank") -> DataFrame:
    """Rank a per-model table (one row per model: tiny window)."""
    w = Window.orderBy(*[F.col(c).desc() for c in by], F.col("model").asc())
    return table.withColumn(col, F.row_number().over(w))
