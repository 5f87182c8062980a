"""Exact order statistics without a single-task window.

A plain ``row_number() over (order by x)`` or ``percentile(x)`` over a
whole table runs in one task (or holds every distinct value in one
aggregation buffer).  The helpers here compute the same exact answers in
two levels:

1. rows are assigned to a *bucket* that is monotone in the order
   (a hex prefix of a digest, or the partition id after a range
   repartition, written with the rows);
2. per-bucket totals (one row for each bucket of a partition group) get a
   running sum - the only un-partitioned window - and are joined back;
3. the running sum inside each bucket is a window partitioned by bucket.

Hot keys are pre-aggregated before any of this (a value that holds a
third of all rows becomes one row), so no bucket grows with a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrite.session import materialize

_B = "_bucket"


def _buckets(df: DataFrame) -> int:
    """Four buckets for each shuffle partition: the setting that grows with the data sizes them."""
    return max(8, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def hash_depth(df: DataFrame) -> int:
    """Hex-prefix length that gives ``_buckets`` buckets or more; no pass over the rows."""
    d = 1
    while 16 ** d < _buckets(df):
        d += 1
    return d


def running_totals(df: DataFrame, partition_cols: Sequence[str],
                   order: Sequence[Column], value_cols: Sequence[str],
                   bucket: Column | None = None, n_buckets: int | None = None,
                   prefix: str = "cum_", return_totals: bool = False):
    """Add ``cum_<v>``: running sum of each value column, inclusive.

    ``order`` must be a total order inside each partition group (ties make
    running sums depend on the physical order).  ``bucket`` must be
    monotone in ``order`` inside a partition group and a function of the row;
    if omitted, the rows are range-partitioned on (partition_cols, order) and
    written once with the partition id as their bucket, so that totals and
    rows read the same buckets.  ``return_totals`` also returns the per-group
    totals, summed from the bucket totals (no further pass over the rows).
    """
    pcols = list(partition_cols)
    if bucket is None:
        df = materialize(df.repartitionByRange(n_buckets or _buckets(df), *[F.col(c) for c in pcols], *order)
                         .withColumn(_B, F.spark_partition_id()), "ordered")
    else:
        df = df.withColumn(_B, bucket)
    totals = df.groupBy(*pcols, _B).agg(*[F.sum(v).alias(v) for v in value_cols])
    before = (Window.partitionBy(*pcols).orderBy(_B)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*pcols, _B, *[
        F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_off_{v}")
        for v in value_cols])
    inside = (Window.partitionBy(*pcols, _B).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    # AQE broadcasts the offsets if their measured size is under its threshold.
    out = df.join(offsets, on=[*pcols, _B], how="inner")
    out = out.select(*df.columns, *[
        (F.sum(v).over(inside) + F.col(f"_off_{v}")).alias(f"{prefix}{v}")
        for v in value_cols])
    out = out.drop(_B)
    if return_totals:
        group = totals.groupBy(*pcols).agg(*[F.sum(v).alias(v) for v in value_cols])
        return out, group
    return out


def hash_ranks(df: DataFrame, partition_cols: Sequence[str], hash_col: str,
               key_col: str, depth: int | None = None, rank_col: str = "rank",
               return_totals: bool = False):
    """1-based rank inside each partition group in (hash, key) order.

    The bucket is the first ``depth`` hex characters of the digest, which
    is monotone in the digest order: 16**depth buckets at most.  Without
    ``depth`` it follows the number of shuffle partitions.
    """
    if depth is None:
        depth = hash_depth(df)
    one = "_one"
    res = running_totals(
        df.withColumn(one, F.lit(1).cast("bigint")), partition_cols,
        [F.col(hash_col), F.col(key_col)], [one],
        bucket=F.substring(F.col(hash_col), 1, depth), return_totals=return_totals)
    ranked, sizes = res if return_totals else (res, None)
    ranked = ranked.withColumnRenamed(f"cum_{one}", rank_col).drop(one)
    if return_totals:
        return ranked, sizes.withColumnRenamed(one, "n_group")
    return ranked


# Rank error of the sketches that place the cuts, and half the distance between
# the two cuts around a quantile, both as shares of a group.
SKETCH_ERROR = 1 / 5000
CUT_MARGIN = 2 * SKETCH_ERROR
# Rows of a cell that one task may put in order (equal values are one row by
# then); a larger cell is cut again, evenly, into so many parts.
IN_ORDER = 1_000_000
PARTS = 64


def _wanted_ranks(probs: Sequence[float], total: Column) -> Column:
    """0-based ranks on both sides of each quantile's position ``p * (total - 1)``."""
    at = [(total - 1).cast("double") * F.lit(float(p)) for p in probs]
    return F.array(*[f(x).cast("bigint") for x in at for f in (F.floor, F.ceil)])


def _cells(inside: DataFrame, of: Sequence[str], v: Column, at: Sequence[float],
           before: Column, total: Column | None, probs: Sequence[float]) -> DataFrame:
    """Cut the values of each ``of`` at its sketched quantiles ``at``; the cells with a wanted rank.

    Every cut is a cell of its own, so a hot value is apart from its
    neighbours, and so is every range between cuts.  A sketch is off by a share
    of the ranks, but any cuts give cells in the order of the values: how good
    they are decides how small the cells are, never which value is found.
    """
    sketch = inside.groupBy(*of).agg(
        F.percentile_approx(v, [float(x) for x in at], round(1 / SKETCH_ERROR)).alias("_cuts"))
    tagged = inside.join(F.broadcast(sketch), list(of))  # a row or a few per group
    cell = sum(((v > F.element_at("_cuts", i + 1)).cast("int") + (v >= F.element_at("_cuts", i + 1)).cast("int")
                for i in range(len(at))), F.lit(0))
    counted = tagged.withColumn("_cell", cell).groupBy(*of, "_cell").agg(
        F.count(F.lit(1)).alias("_size"), F.min(v).alias("_from"), F.max(v).alias("_to"))
    whole = Window.partitionBy(*of)  # 2 * len(at) + 1 cells at most
    counted = counted.withColumn("_total", F.sum("_size").over(whole) if total is None else total).withColumn(
        "_before", before + F.sum("_size").over(whole.orderBy("_cell")) - F.col("_size"))
    return counted.where(F.exists(_wanted_ranks(probs, F.col("_total")),
                                  lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_size"))))


def exact_quantiles(long_df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles per group (like ``percentile``).

    ``long_df`` has one row per observation: group columns and a value.
    Returns one row per group with columns ``q_<i>`` for each probability
    in ``probs`` (nulls ignored; NULL for an empty group).  Groups are columns
    or (class, column) pairs: tables of a few rows a group are broadcast.

    No distinct values are exchanged but those near a quantile: a mergeable
    sketch puts two cuts around each quantile, the rows between cuts are
    counted (in each task first), and the few cells that hold a wanted rank, some
    ``2 * CUT_MARGIN`` of the rows, are read once more and put in order.  A cell
    of over ``IN_ORDER`` rows is cut again before.  ``long_df`` is read three
    times, and twice more for each further cut.
    """
    g = list(group_cols)
    v = F.col(value_col)
    values = long_df.where(v.isNotNull()).select(*g, value_col)
    around = sorted({min(1.0, max(0.0, p + s * CUT_MARGIN)) for p in probs for s in (-1, 1)})
    cells = _cells(values, g, v, around, F.lit(0).cast("bigint"), None, probs)
    keep = [*g, "_from", "_to", "_size", "_total", "_before"]

    def rows_of(cells: DataFrame) -> DataFrame:
        c = cells.select(*g, *[F.col(x).alias(f"_c{x}") for x in keep[len(g):]])
        return values.join(F.broadcast(c), g).where(v.between(F.col("_c_from"), F.col("_c_to")))

    of = [*g, *[f"_c{x}" for x in keep[len(g):]]]
    while True:
        cells = materialize(cells.select(*keep), "cells")
        largest = cells.where(F.col("_from") < F.col("_to")).agg(F.max("_size")).first()[0]
        if (largest or 0) <= IN_ORDER:
            break
        even = [i / PARTS for i in range(1, PARTS)]
        cells = _cells(rows_of(cells), of, v, even, F.col("_c_before"), F.col("_c_total"), probs)
    counts = rows_of(cells).groupBy(*of, value_col).agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(*of).orderBy(v).rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("_upto", F.col("_c_before") + F.sum("_n").over(run))  # the value's last rank, plus 1
    picked = []
    for i, p in enumerate(probs):
        pos = (F.col("_c_total") - 1).cast("double") * F.lit(float(p))
        for name, r in ((f"_lo{i}", F.floor(pos)), (f"_hi{i}", F.ceil(pos))):
            holds = (r.cast("bigint") >= F.col("_upto") - F.col("_n")) & (r.cast("bigint") < F.col("_upto"))
            picked.append(F.max(F.when(holds, v)).alias(name))
        picked.append(F.max(pos - F.floor(pos)).alias(f"_f{i}"))
    found = cum.groupBy(*g).agg(*picked)
    return found.select(*g, *[
        F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}"))
         .otherwise(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q_{i}")
        for i in range(len(probs))])
