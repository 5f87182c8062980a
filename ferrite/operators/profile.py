"""Profiling aggregations.

Every profile is one or two scans: wide aggregates are computed in a
single ``agg`` (partial aggregation on the map side, a one-row merge),
and per-column results come out in long form via ``unpivot`` (Expand),
so adding columns never adds scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.functions import attach_one_row, ratio
from ferrite.operators.comoments import pair_moments
from ferrite.operators.ordered import exact_quantiles
from ferrite.schema import TARGET
from ferrite.session import materialize


def long_values(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (),
                name: str = "column_name", value: str = "value") -> DataFrame:
    """Wide to long (B18): one row per (row, column), values as DOUBLE."""
    w = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return w.unpivot(list(ids), list(cols), name, value)


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def column_types(df: DataFrame) -> DataFrame:
    """Position, name, Spark SQL type and non-null count per column.

    Types come from the schema; the counts are one aggregate (one scan),
    spread to one row per column.
    """
    fields = list(df.schema.fields)
    wide = df.agg(*[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
    entries = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f"c{i}").alias("n_non_null")) for i, f in enumerate(fields)]
    return wide.select(F.inline(F.array(*entries)))


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D3: null count and percentage per column, one scan."""
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(c) for c in cols])
    long = wide.unpivot(["_n"], list(cols), "column_name", "n_null")
    return long.select("column_name", "n_null",
                       F.round(ratio(F.col("n_null") * 100, F.col("_n")), 6).alias("pct_null"))


def _fingerprint(cols: Sequence[str]) -> list:
    """Two 64-bit hashes of a row.  A null leaves ``xxhash64`` as it was, so which columns are null is hashed too."""
    seen = [F.col(c) for c in cols]
    nulls = F.array(*[c.isNull() for c in seen])
    return [F.xxhash64(nulls, *seen).alias("_f1"), F.xxhash64(F.lit(1), *reversed(seen), nulls).alias("_f2")]


def duplicate_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows equal to an earlier row on ``cols`` (nulls compare equal).

    Rows are counted by a fingerprint of 128 bits, so 24 bytes a row are
    exchanged.  A fingerprint of one row is a distinct row; only rows that share
    one are compared in full.
    """
    rows = df.select(*cols, *_fingerprint(cols))
    prints = rows.groupBy("_f1", "_f2").agg(F.count(F.lit(1)).alias("_c"))
    several = materialize(prints.where(F.col("_c") > 1), "prints")
    # written, so Spark knows its size: the rows are exchanged for it only where it is large
    full = rows.join(several.select("_f1", "_f2"), ["_f1", "_f2"], "left_semi").groupBy("_f1", "_f2", *cols).agg(F.lit(1))
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    counted = attach_one_row(counted, several.agg(F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("_alike")))
    counted = attach_one_row(counted, full.agg(F.count(F.lit(1)).alias("_full")))
    n_distinct = F.col("n_rows") - F.col("_alike") + F.col("_full")
    return counted.select("n_rows", n_distinct.alias("n_distinct"), (F.col("n_rows") - n_distinct).alias("n_duplicates"))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact form: one aggregate (Spark expands rows once per column and
    de-duplicates map-side).  ``approx=True`` uses HyperLogLog++ sketches,
    constant memory per column, for very wide or very large tables.
    """
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    wide = df.agg(*[f(F.col(c)).cast("bigint").alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column_name", "n_distinct")


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count and share of every value of each categorical column."""
    w = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    long = w.unpivot([], list(cols), "column_name", "value")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    per_col = Window.partitionBy("column_name")  # tiny: one row per distinct value
    return counts.select("column_name", "value", "n",
                         F.round(ratio(F.col("n"), F.sum("n").over(per_col)), 6).alias("share"))


DESCRIBE_PROBS = (0.25, 0.5, 0.75)


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column."""
    long = long_values(df, cols)
    moments = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
        F.max("value").alias("max"))
    q = exact_quantiles(long, ["column_name"], "value", DESCRIBE_PROBS)
    out = moments.join(q, "column_name", "left")
    r = lambda c: F.round(F.col(c), 6)
    return out.select("column_name", "count", r("mean").alias("mean"), r("std").alias("std"),
                      r("min").alias("min"), r("q_0").alias("p25"), r("q_1").alias("p50"),
                      r("q_2").alias("p75"), r("max").alias("max"))


def kpis(df: DataFrame, label: str = TARGET) -> DataFrame:
    """Totals, failure rate, class ratio, naive accuracy."""
    y = F.col(label)
    a = df.agg(F.count(F.lit(1)).alias("n_rows"),
               F.count_if(y == 1).alias("n_failures"),
               F.count_if(y == 0).alias("n_non_failures"))
    return a.select(
        "n_rows", "n_failures", "n_non_failures",
        F.round(ratio(F.col("n_failures") * 100, F.col("n_rows")), 6).alias("failure_rate_pct"),
        F.round(ratio(F.col("n_non_failures"), F.col("n_failures")), 6).alias("class_ratio"),
        F.round(ratio(F.col("n_non_failures"), F.col("n_rows")), 6).alias("naive_accuracy"))


def group_profile(df: DataFrame, by: str, sensors: Sequence[str], label: str = TARGET) -> DataFrame:
    """Rows, failures, failure rate and sensor null share per group."""
    n = F.count(F.lit(1))
    nulls = sum((n - F.count(F.col(c)) for c in sensors), F.lit(0))
    a = df.groupBy(by).agg(n.alias("n_rows"), F.count_if(F.col(label) == 1).alias("n_failures"),
                           nulls.alias("_nulls"))
    return a.select(by, "n_rows", "n_failures",
                    F.round(ratio(F.col("n_failures"), F.col("n_rows")), 6).alias("failure_rate"),
                    F.round(ratio(F.col("_nulls"), F.col("n_rows") * len(sensors)), 6)
                    .alias("sensor_null_share"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every ordered pair, pairwise deletion of nulls.

    One scan adds co-moments under the mask of present values
    (``comoments.pair_moments``).  A column's r with itself is 1, or null where
    it does not vary; r of a pair is null where it has fewer than two rows or
    one side does not vary over them, and NaN where a value in them is not
    finite.  Long form (col_a, col_b, r).
    """
    cols = list(cols)
    names = F.array(*[F.lit(c) for c in cols])
    m = pair_moments(df, cols)
    varies = (F.col("n") > 1) & ~F.col("steady_a") & ~F.col("steady_b")
    r = F.when(F.col("i") == F.col("j"), F.when(varies | (F.col("odd") > 0), F.lit(1.0))) \
         .when(F.col("odd") > 0, F.lit(float("nan"))) \
         .when(varies, F.col("cross") / F.sqrt("sq_a") / F.sqrt("sq_b"))
    places = F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("p"), F.col("j").alias("q")))) \
              .otherwise(F.array(F.struct(F.col("i").alias("p"), F.col("j").alias("q")),
                                 F.struct(F.col("j").alias("p"), F.col("i").alias("q"))))
    out = m.select(F.round(r, 6).alias("r"), F.explode(places).alias("e"))
    return out.select(names[F.col("e.p")].alias("col_a"), names[F.col("e.q")].alias("col_b"), "r")


def _bounds(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"),
                                   F.count("value").alias("n_values"))


def bin_of(value, lo, hi, bins: int):
    """Equal-width bin 1..bins; a value equal to the maximum is in the last bin."""
    raw = F.floor((value - lo) * F.lit(bins) / F.nullif(hi - lo, F.lit(0.0))).cast("bigint") + 1
    return F.least(F.coalesce(raw, F.lit(1).cast("bigint")), F.lit(bins).cast("bigint"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 50, by: str | None = None,
              range_per_group: bool = False, density: bool = False) -> DataFrame:
    """Equal-width histograms in long form, empty bins included.

    ``by`` splits counts by a class column; ``range_per_group`` takes each
    class's own min/max (D16) instead of the pooled one (D17); ``density``
    adds ``count / (n * width)``.
    """
    ids = [by] if by else []
    long = long_values(df, cols, ids).where(F.col("value").isNotNull())
    bkeys = ["column_name"] + (ids if range_per_group else [])
    bounds = _bounds(long, bkeys)
    # One row per column (per class): bounded, broadcast to the value scan.
    binned = long.join(F.broadcast(bounds.select(*bkeys, "lo", "hi")), bkeys).select(
        *ids, "column_name", bin_of(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"))
    counts = binned.groupBy(*ids, "column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
    if by and not range_per_group:
        # (class, column) groups with values, each with the pooled bounds.
        groups = long.groupBy(by, "column_name").agg(F.count(F.lit(1)).alias("n_group"))
        grid_src = groups.join(F.broadcast(bounds), "column_name")  # one row per column
    else:
        grid_src = bounds.withColumn("n_group", F.col("n_values"))
    grid = grid_src.select(*ids, "column_name", "lo", "hi", "n_group",
                           F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin"))
    out = grid.join(counts, [*ids, "column_name", "bin"], "left")
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    cnt = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    sel = [*ids, "column_name", "bin",
           F.round(F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") - 1) / F.lit(bins), 6).alias("bin_lo"),
           F.round(F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("bin") / F.lit(bins), 6).alias("bin_hi"),
           cnt.alias("n")]
    if density:
        sel.append(F.round(ratio(cnt, F.col("n_group") * width), 6).alias("density"))
    return out.select(*sel)


def box_stats(df: DataFrame, cols: Sequence[str], by: str = TARGET) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count per class and column."""
    long = long_values(df, cols, [by]).where(F.col("value").isNotNull())
    q = exact_quantiles(long, [by, "column_name"], "value", DESCRIBE_PROBS)
    q = q.select(by, "column_name", F.col("q_0").alias("q1"), F.col("q_1").alias("median"),
                 F.col("q_2").alias("q3"))
    fences = q.select("*", (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_lf"),
                      (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_hf"))
    v = F.col("value")
    # One row per (class, column): bounded, broadcast.
    j = long.join(F.broadcast(fences), [by, "column_name"])
    a = j.groupBy(by, "column_name").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(v >= F.col("_lf"), v)).alias("whisker_lo"),
        F.max(F.when(v <= F.col("_hf"), v)).alias("whisker_hi"),
        F.count_if((v < F.col("_lf")) | (v > F.col("_hf"))).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    r = lambda c: F.round(F.col(c), 6).alias(c)
    return a.select(by, "column_name", "n", r("q1"), r("median"), r("q3"),
                    F.round(F.col("q3") - F.col("q1"), 6).alias("iqr"),
                    r("whisker_lo"), r("whisker_hi"), "n_outliers")


def stage_profile(df: DataFrame, cols: Sequence[str], stage: str) -> DataFrame:
    """Null count, mean, median and population std per column for one stage."""
    long = long_values(df, cols)
    m = long.groupBy("column_name").agg(
        (F.count(F.lit(1)) - F.count("value")).alias("n_null"),
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    med = exact_quantiles(long, ["column_name"], "value", [0.5])
    out = m.join(med, "column_name", "left")
    # "+ 0.0" turns a rounded -0.0 (means of centred data) into 0.0.
    z = F.lit(0.0)
    return out.select(F.lit(stage).alias("stage"), "column_name", "n_null",
                      (F.round("mean", 6) + z).alias("mean"), (F.round("q_0", 6) + z).alias("median"),
                      (F.round("std", 6) + z).alias("std"))


def before_after(raw: DataFrame, prepared: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The same profile before and after preparation, stacked by stage."""
    return stage_profile(raw, cols, "raw").unionByName(stage_profile(prepared, cols, "prepared"))


def domain_violations(df: DataFrame, numeric_domain: dict, categorical_domain: dict) -> DataFrame:
    """Rows outside the accepted range / level set, per column, one scan."""
    exprs = []
    for c, (lo, hi) in numeric_domain.items():
        exprs.append(F.count_if(~F.col(c).between(lo, hi)).alias(c))
    for c, levels in categorical_domain.items():
        exprs.append(F.count_if(~F.col(c).isin(*levels)).alias(c))
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *exprs)
    long = wide.unpivot(["_n"], list(numeric_domain) + list(categorical_domain), "column_name", "n_violations")
    return long.select("column_name", "n_violations", F.col("_n").alias("n_rows"))
