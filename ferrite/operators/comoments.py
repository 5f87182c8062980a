"""Co-moments of all pairs of columns, each over the rows where both are present.

A task keeps one small matrix for each sum (pairs by pairs, for ten columns a
few kilobytes) and adds a batch to it by matrix products with the mask of
present values, so a row is read once and never copied for its pairs.  Sums
are taken around the means of a batch and merged by the rule for parallel
moments, first in the task and then, one row a pair and task, in SQL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FIELDS = ("n", "mean_a", "mean_b", "sq_a", "sq_b", "cross", "lo_a", "hi_a", "lo_b", "hi_b", "odd")


def _batch_moments(x: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
    """Moments of a batch; entry (i, j) is of column i over the rows that hold i and j."""
    finite = np.isfinite(x)
    odd = (present & ~finite).astype(float)
    use = present & finite
    m = use.astype(float)
    x = np.where(use, x, 0.0)
    centre = x.sum(axis=0) / np.maximum(m.sum(axis=0), 1)
    z = np.where(use, x - centre, 0.0)
    n = m.T @ m
    some = np.maximum(n, 1)
    a = z.T @ m
    k = x.shape[1]
    lo, hi = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    for j in range(k):
        both = use & use[:, j:j + 1]
        lo[:, j] = np.where(both, x, np.inf).min(axis=0, initial=np.inf)
        hi[:, j] = np.where(both, x, -np.inf).max(axis=0, initial=-np.inf)
    here = present.astype(float)
    return {"n": n, "mean": np.where(n > 0, centre[:, None] + a / some, 0.0), "sq": (z * z).T @ m - a * a / some,
            "cross": z.T @ z - a * a.T / some, "lo": lo, "hi": hi, "odd": odd.T @ here + here.T @ odd}


def _merged(s: dict[str, np.ndarray], t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    n = s["n"] + t["n"]
    some = np.maximum(n, 1)
    apart, w = t["mean"] - s["mean"], s["n"] * t["n"] / some
    return {"n": n, "mean": s["mean"] + apart * t["n"] / some, "sq": s["sq"] + t["sq"] + apart * apart * w,
            "cross": s["cross"] + t["cross"] + apart * apart.T * w,
            "lo": np.minimum(s["lo"], t["lo"]), "hi": np.maximum(s["hi"], t["hi"]), "odd": s["odd"] + t["odd"]}


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row for each unordered pair of columns and each column with itself:
    i, j (places in ``cols``, i <= j), n, sq_a, sq_b and cross (sums of squares
    and products around the means), steady_a and steady_b (one value only) and
    odd (rows with a value that is not finite).  No rows give no pairs."""
    k = len(cols)
    first, second = np.triu_indices(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns], axis=1)
            found = _batch_moments(x, np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], axis=1))
            total = found if total is None else _merged(total, found)
        if total is None:
            return
        def side(name):
            return total[name][first, second], total[name].T[first, second]
        (mean_a, mean_b), (sq_a, sq_b), (lo_a, lo_b), (hi_a, hi_b) = side("mean"), side("sq"), side("lo"), side("hi")
        values = [total["n"][first, second], mean_a, mean_b, sq_a, sq_b, total["cross"][first, second],
                  lo_a, hi_a, lo_b, hi_b, total["odd"][first, second]]
        yield pa.RecordBatch.from_arrays([pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))]
                                         + [pa.array(v) for v in values], names=["i", "j", *_FIELDS])

    parts = df.select(*[F.col(c).cast("double").alias(f"_{p}") for p, c in enumerate(cols)]) \
        .mapInArrow(run, "i int, j int, " + ", ".join(f"{f} double" for f in _FIELDS))
    pair = Window.partitionBy("i", "j")  # one row for each task
    share = F.try_divide(F.col("n"), F.sum("n").over(pair))
    for s in "ab":
        parts = parts.withColumn(f"_off_{s}", F.col(f"mean_{s}") - F.sum(F.col(f"mean_{s}") * share).over(pair))
    added = lambda c, off: F.sum(F.col(c) + F.col("n") * off)
    return parts.groupBy("i", "j").agg(
        F.sum("n").cast("bigint").alias("n"),
        added("sq_a", F.col("_off_a") * F.col("_off_a")).alias("sq_a"),
        added("sq_b", F.col("_off_b") * F.col("_off_b")).alias("sq_b"),
        added("cross", F.col("_off_a") * F.col("_off_b")).alias("cross"),
        (F.min("lo_a") >= F.max("hi_a")).alias("steady_a"), (F.min("lo_b") >= F.max("hi_b")).alias("steady_b"),
        F.sum("odd").cast("bigint").alias("odd"))
