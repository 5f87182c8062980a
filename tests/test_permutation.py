"""The keyed permutation of ranks is a bijection, also where it has to walk, and differs by key."""

import pytest
from pyspark.sql import functions as F

from ferrite.operators import explain as X


def ranks(spark, n, keys):
    pairs = F.array(*[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
                      for a, b in zip(keys[::2], keys[1::2])])
    df = spark.range(n).select(F.col("id").alias("i"), F.lit(n).cast("bigint").alias("n"), pairs.alias("k"))
    return [r.p for r in X.with_permuted_rank(df, "i", "n", "k", "p").orderBy("i").collect()]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 101, 5000])
def test_bijection(spark, n):
    p = ranks(spark, n, X.permutation_keys(42, "rpm", 0))
    assert sorted(p) == list(range(n))


def test_looks_random(spark):
    n = 5000
    one, two = (ranks(spark, n, X.permutation_keys(42, "rpm", r)) for r in (0, 1))
    for p in (one, two):
        mean = (n - 1) / 2
        corr = sum((i - mean) * (x - mean) for i, x in enumerate(p)) / sum((i - mean) ** 2 for i in range(n))
        assert abs(corr) < 0.06  # four standard deviations of a random permutation
        follows = sum(b - a == 1 for a, b in zip(p, p[1:]))
        assert follows < 10 and sum(i == x for i, x in enumerate(p)) < 10
    assert sum(a == b for a, b in zip(one, two)) < 10


def test_empty_table(spark):
    df = spark.createDataFrame([], "reading_id BIGINT, a DOUBLE")
    assert X.permuted_rows(df, ["a"], 2).count() == 0


def test_copies_are_not_broadcast(spark):
    df = spark.range(100).select(F.col("id").alias("reading_id"), F.col("id").cast("double").alias("a"))
    plan = X.permuted_rows(df, ["a"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
