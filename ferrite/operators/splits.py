"""Exact stratified splits, folds and hash-ordered samples.

A row's place in the random order is ``md5(key-seed)`` (ties by key), so
splits are reproducible across runs, cluster sizes and engines.  Quotas
are exact (not Bernoulli like ``sampleBy``): ``ceil(f * n)`` rows in
total, ``floor`` per class, the leftover to the largest remainders.
Which rows are a class's first ones is found by ``selection.first_in_order``;
ranks, where a fold needs them, come from ``hash_ranks``, which never puts a
whole class in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrite.functions import hash_key
from ferrite.operators.ordered import hash_ranks
from ferrite.operators.selection import first_in_order
from ferrite.schema import KEY, TARGET

_H = "_h"


def class_counts(df: DataFrame, label: str = TARGET) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))


def class_quotas(counts: DataFrame, label: str, fraction: float) -> DataFrame:
    """Per class: ``quota`` rows of ``n_class`` go to the held-out part.

    Works on the class-count table (one row per class), so every window
    here is over a handful of rows.
    """
    frac = F.lit(str(fraction)).cast("decimal(20,10)")
    everything = Window.partitionBy()
    c = counts.select(label, "n_class", F.sum("n_class").over(everything).alias("n"))
    c = c.withColumn("n_out", F.ceil(F.col("n").cast("decimal(38,0)") * frac).cast("bigint"))
    c = c.withColumn("_base", F.expr("(n_out * n_class) div n")) \
         .withColumn("_rem", F.expr("(n_out * n_class) % n"))
    left = F.col("n_out") - F.sum("_base").over(everything)
    order = Window.orderBy(F.col("_rem").desc(), F.col(label).asc())
    extra = F.when(F.row_number().over(order) <= left, 1).otherwise(0)
    return c.select(label, "n_class", (F.col("_base") + extra).cast("bigint").alias("quota"))


def ranked(df: DataFrame, label: str, seed, key: str = KEY, rank_col: str = "rank") -> DataFrame:
    """Rank of each row inside its class in hash order (1-based)."""
    return hash_ranks(df.withColumn(_H, hash_key(seed, key)), [label], _H, key, rank_col=rank_col).drop(_H)


def stratified_split(df: DataFrame, label: str = TARGET, fraction: float = 0.2, seed=42,
                     key: str = KEY, split_col: str = "split",
                     names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """add ``split_col`` = names[1] for the held-out rows, names[0] otherwise.

    The class's quota-th row in hash order is found by counting digests, so no
    row is exchanged or sorted (``selection.first_in_order``).
    """
    def held_out(sizes: DataFrame) -> DataFrame:
        return class_quotas(sizes, label, fraction).select(label, F.col("quota").alias("_k"))

    s = first_in_order(df, label, hash_key(seed, key), key, held_out, "_out")
    part = F.when(F.col("_out"), F.lit(names[1])).otherwise(F.lit(names[0]))
    return s.withColumn(split_col, part).drop("_out")


def fold_assignment(df: DataFrame, k: int = 5, label: str = TARGET, seed=42,
                    key: str = KEY, fold_col: str = "fold") -> DataFrame:
    """stratified k folds; per class, fold sizes differ by at most one."""
    r = ranked(df, label, seed, key, "_rank")
    return r.withColumn(fold_col, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_rank")


def validation_indicator(df: DataFrame, fraction: float = 0.2, label: str = TARGET,
                         seed=42, key: str = KEY, col: str = "is_validation") -> DataFrame:
    """boolean column for a stratified held-out share (early stopping)."""
    s = stratified_split(df, label, fraction, seed, key, "_part", ("fit", "validation"))
    return s.withColumn(col, F.col("_part") == "validation").drop("_part")


def hash_sample(df: DataFrame, n: int = 100, seed=42, key: str = KEY) -> DataFrame:
    """F8: fixed-size sample, the first ``n`` rows in hash order.

    A distributed top-k (TakeOrderedAndProject): each task keeps its best
    ``n`` rows, so only ``n x tasks`` rows meet in the final merge.
    """
    return (df.withColumn(_H, hash_key(seed, key)).orderBy(F.col(_H), F.col(key))
              .limit(n).drop(_H))
