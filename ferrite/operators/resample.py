"""Class rebalancing (F4-F7): weights, over- and under-sampling, SMOTE.

Everything is driven by the class-count table (one row per class), which
is broadcast back to the rows; row selection uses the same hash order as
the splits, so results are reproducible and never pass through the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrite.functions import attach_one_row, hash_key
from ferrite.operators.selection import first_in_order
from ferrite.operators.splits import class_counts
from ferrite.schema import KEY, TARGET


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """balanced weights ``n / (n_classes * n_c)``."""
    c = class_counts(df, label)
    everything = Window.partitionBy()
    return c.select(label, "n_class",
                    (F.sum("n_class").over(everything).cast("double")
                     / (F.count(F.lit(1)).over(everything) * F.col("n_class"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = TARGET, weight_col: str = "weight") -> DataFrame:
    w = class_weights(df, label).select(label, F.col("weight").alias(weight_col))
    return df.join(F.broadcast(w), label)  # one row per class


def undersample(df: DataFrame, label: str = TARGET, seed=42, key: str = KEY) -> DataFrame:
    """every class cut to the smallest class size, first rows in hash order."""
    def smallest(sizes: DataFrame) -> DataFrame:
        return sizes.select(label, F.min("n_class").over(Window.partitionBy()).alias("_k"))

    return first_in_order(df, label, hash_key(seed, key), key, smallest, "_in").where("_in").drop("_in")


def oversample(df: DataFrame, label: str = TARGET, seed=42, key: str = KEY,
               copy_col: str = "copy") -> DataFrame:
    """every class grown to the largest class size by whole copies.

    Class c gets ``floor(n_max / n_c)`` copies of each row, plus one more
    for its first ``n_max % n_c`` rows in hash order: exact class sizes,
    copies spread as evenly as possible.  ``copy`` numbers them from 1.
    """
    r = with_copies(df, label, seed, key, "_copies")
    return r.withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies")


def with_copies(df: DataFrame, label: str = TARGET, seed=42, key: str = KEY, copies_col: str = "copies", among: Column | None = None) -> DataFrame:
    """Each row once, with the number of its copies in ``oversample``.

    ``among``: the rows that are copied, as if there were no others, which have 0 copies then.
    """
    group, rest = (label, None) if among is None else ("_class", "")
    if among is not None:
        df = df.withColumn(group, F.when(among, F.col(label).cast("string")).otherwise(rest))

    def extra(sizes: DataFrame) -> DataFrame:
        copied = F.lit(True) if rest is None else F.col(group) != rest
        n_max = F.max(F.when(copied, F.col("n_class"))).over(Window.partitionBy())
        return sizes.select(group, F.when(copied, F.floor(n_max / F.col("n_class"))).otherwise(0).alias("_whole"),
                            F.when(copied, n_max % F.col("n_class")).otherwise(0).alias("_k"))

    r = first_in_order(df, group, hash_key(seed, key), key, extra, "_more")
    r = r.withColumn(copies_col, (F.col("_whole") + F.col("_more").cast("int")).cast("int")).drop("_whole", "_more")
    return r if among is None else r.drop(group)


def smote(df: DataFrame, label: str = TARGET, features: str = "features", k: int = 5, seed=42,
          key: str = KEY, minority: int = 1, search=None) -> DataFrame:
    """synthetic minority rows until the classes are equal.

    Synthetic row i (1..n_maj - n_min) takes minority row ``(i-1) % P + 1``
    in hash order as parent, its neighbour ``md5(i-k) % k + 1`` among the
    exact k nearest minority rows, and a gap ``g`` in [0, 1) from
    ``md5(i-g)``: ``x + g * (nn - x)``.  Parents are exploded from the
    minority rows themselves (no driver loop, no single task).  Returns
    the input rows plus the synthetic ones (key = -i): both classes have N
    rows then, or the input as it is where the minority is no smaller.  With
    k minority rows or fewer the query fails.  ``search`` replaces the exact
    neighbour search, as ``hashed.knn_hashed`` for many dimensions.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from ferrite.functions import hash_unit
    from ferrite.operators.neighbors import knn, knn_points
    from ferrite.operators.splits import ranked

    counts = class_counts(df, label)
    c = counts.agg(F.sum(F.when(F.col(label) == minority, F.col("n_class"))).alias("P"),
                   F.sum(F.when(F.col(label) != minority, F.col("n_class"))).alias("N"))
    mino = df.where(F.col(label) == minority).select(key, label, vector_to_array(F.col(features)).alias("_x"))
    nn = knn_points(mino, key, "_x", k, seed, search or knn)
    r = attach_one_row(ranked(mino, label, seed, key, "_r"), c)
    n_syn = F.greatest(F.col("N") - F.col("P"), F.lit(0))
    copies = F.floor((n_syn - F.col("_r")) / F.col("P")) + 1
    # a sequence to -1 would count down, so parents without a copy go first
    enough = F.when(F.col("P") > k, F.col("_r")).otherwise(
        F.raise_error(F.lit(f"smote needs more than k={k} minority rows")).cast("bigint"))
    syn = r.where(F.col("_r") <= n_syn).withColumn("_r", enough).withColumn("_t", F.explode(F.sequence(F.lit(0), copies.cast("int") - 1)))
    syn = syn.withColumn("_i", F.col("_r") + F.col("_t") * F.col("P"))
    hi = F.col("_i").cast("string")
    j = F.pmod(F.conv(F.substring(F.md5(F.concat(hi, F.lit("-k"))), 1, 8), 16, 10).cast("bigint"), F.lit(k)) + 1
    g = hash_unit(F.md5(F.concat(hi, F.lit("-g"))))
    syn = syn.select(key, "_x", "_i", j.alias("nn_rank"), g.alias("_g"))
    syn = syn.join(nn.select(key, "nn_rank", "nn_key"), [key, "nn_rank"])
    nbr = mino.select(F.col(key).alias("nn_key"), F.col("_x").alias("_nx"))
    syn = syn.join(nbr, "nn_key")
    new = F.zip_with(F.col("_x"), F.col("_nx"), lambda a, b: a + F.col("_g") * (b - a))
    out = syn.select((-F.col("_i")).cast(df.schema[key].dataType).alias(key),
                     F.lit(minority).cast(df.schema[label].dataType).alias(label),
                     array_to_vector(new).alias(features))
    return df.select(key, label, features).unionByName(out)
