"""Column expressions shared by the operators.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrite.schema import KEY, MODERATE_RISK_FLOOR


def hash_key(seed, key: str = KEY, *extra) -> Column:
    """Deterministic pseudo-random order: md5 of ``key-seed[-extra...]``.

    md5 is used (not xxhash64) because other engines compute the same
    digest, so orders derived from it can be checked independently.
    """
    parts = [F.col(key).cast("string"), F.lit("-"), F.lit(str(seed))]
    for e in extra:
        parts += [F.lit("-"), e if isinstance(e, Column) else F.lit(str(e))]
    return F.md5(F.concat(*parts))


def hash_unit(h: Column, start: int = 1, length: int = 8) -> Column:
    """Map a hex digest slice to a double in [0, 1)."""
    return F.conv(F.substring(h, start, length), 16, 10).cast("double") / float(16 ** length)


def ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (ANSI-safe)."""
    num = num if isinstance(num, Column) else F.lit(num)
    den = den if isinstance(den, Column) else F.lit(den)
    return F.try_divide(num.cast("double"), den.cast("double"))


def relative_saving(a, b) -> Column:
    """``(1 - a/b) * 100``: what a saves against b, in percent."""
    return (F.lit(1.0) - ratio(a, b)) * 100


def decide(score: Column, threshold) -> Column:
    """Class decision ``score >= t`` as 0/1."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (score >= t).cast("int")


def risk_tier(score: Column, threshold, floor: float = MODERATE_RISK_FLOOR) -> Column:
    """Three risk tiers (B15): high at the threshold, moderate from the floor."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (F.when(score >= t, F.lit("high"))
            .when(score >= F.lit(floor), F.lit("moderate"))
            .otherwise(F.lit("low")))


def strip_prefixes(c: Column) -> Column:
    """Encoded feature name without its ``num__`` / ``cat__`` prefix."""
    return F.replace(F.replace(c, F.lit("num__"), F.lit("")), F.lit("cat__"), F.lit(""))


def attach_one_row(df, one_row):
    """Append the columns of a one-row table (a global aggregate such as
    class totals or a baseline metric) to every row of ``df``.

    Each column becomes a scalar subquery: Spark computes the aggregate
    once (MergeScalarSubqueries folds the columns into one subquery) and
    inlines the values, so ``df`` streams through without a join or a
    shuffle.  A ``one_row`` with more than one row fails the query.
    """
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])
