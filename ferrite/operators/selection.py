"""The first k rows of each group in hash order, without ranking the rows.

A rank costs an exchange and a sort of whole rows.  To know which rows are
among the first k it is enough to know the k-th one: digests are counted by
a prefix, the prefix that holds the k-th row is found in the running sum of
the counts, and only its rows are looked at again, by the next digits.  What
is exchanged is counts; membership is then a comparison of a row's digest
with its group's cut, made where the row lies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrite.session import materialize

# Hex digits of the digest that a pass counts by: 4,096 counters a group.
DIGITS = 3
# Rows with one prefix that one task may put in order; beyond that they are
# counted again by the next digits.
IN_ORDER = 200_000


def _border(counts: DataFrame, targets: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Per group, the row of ``counts`` where the running sum reaches the group's ``_k`` (null: none).

    ``_k`` becomes the place among the rows that this one stands for.
    """
    upto = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cum = counts.withColumn("_cum", F.sum("_n").over(upto))
    hit = cum.join(F.broadcast(targets.select(group, "_k")), group)  # one row per group
    return (hit.where((F.col("_k") > F.col("_cum") - F.col("_n")) & (F.col("_k") <= F.col("_cum")))
               .withColumn("_k", F.col("_k") - F.col("_cum") + F.col("_n")).drop("_cum"))


def first_in_order(df: DataFrame, group: str, order: Column, key: str,
                   k_of: Callable[[DataFrame], DataFrame], flag: str) -> DataFrame:
    """Add boolean ``flag``: is the row among its group's first k in (``order``, ``key``)?

    ``order`` is a hex digest of the row's key.  ``k_of`` gets the table of
    group sizes (group, n_class), one row a group, and returns it with the
    column ``_k`` (0: none; beyond the size: all) and whatever else the caller
    wants on the rows.  Groups are classes: few, so tables of one row a group
    are broadcast.

    The cuts are found and written when this is called (two scans of the key
    and the group, one more for each further pass); the result is then a
    projection of ``df``, however often it is read.  ``df`` should be a table
    or a projection of one.  Rows of a null group are left out.  A null key
    comes first in the order.  Rows that repeat a key share a digest and stay
    together, which can make the selection larger than k by the copies of the
    last key (none where keys are unique).  An empty table gives an empty table.
    """
    digest = F.coalesce(order, F.lit(""))
    rows = df.select(F.col(group), F.col(key).alias("_key"), digest.alias("_h"))

    def prefix(start: int) -> Column:
        return F.substring("_h", start, DIGITS)

    counts = rows.groupBy(group, prefix(1).alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = k_of(counts.groupBy(group).agg(F.sum("_n").alias("n_class")))
    border = _border(counts, sizes, group, ["_b"]).withColumnRenamed("_k", "_place")
    sizes = materialize(sizes.join(F.broadcast(border), group, "left"), "cuts")
    at, start = sizes.select(group, F.col("_b").alias("_at"), F.col("_place").alias("_k"), "_n"), 1
    while True:
        rows = rows.join(F.broadcast(at.select(group, "_at")), group).where(prefix(start) == F.col("_at")).drop("_at")
        start += DIGITS
        # an md5 has 32 digits; what agrees in all of them is one key, or few
        if start > 32 or (at.agg(F.max("_n")).first()[0] or 0) <= IN_ORDER:
            break
        counts = rows.groupBy(group, prefix(start).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
        at = materialize(_border(counts, at, group, ["_at"]), "cuts")
    last = rows.groupBy(group, "_h", "_key").agg(F.count(F.lit(1)).alias("_n"))
    cut = _border(last, at, group, ["_h", "_key"]).select(
        group, F.struct(F.col("_h").alias("h"), F.col("_key").alias("k")).alias("_cut"))
    cut = materialize(sizes.drop("_b", "_place", "_n").join(F.broadcast(cut), group, "left"), "cuts")
    here = F.struct(digest.alias("h"), F.col(key).alias("k"))
    out = df.join(F.broadcast(cut), group)
    return out.withColumn(flag, F.coalesce(here <= F.col("_cut"), F.col("_k") > 0)).drop("_cut", "_k")
