"""The first k of each group by digest counts equal a plain rank, and no row is exchanged for it."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ferrite.functions import hash_key
from ferrite.operators import resample as R
from ferrite.operators import splits as S
from ferrite.operators.selection import first_in_order


def rows(spark, n=3000):
    return spark.range(n).select(F.col("id").alias("reading_id"),
                                 F.when(F.col("id") % 3 == 0, "b").otherwise("a").alias("c"))


def fixed(k):
    return lambda sizes: sizes.select("c", F.lit(k).cast("bigint").alias("_k"))


def plain_rank(df, seed=42):
    h = hash_key(seed, "reading_id")
    return df.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(h, "reading_id")))


@pytest.mark.parametrize("k", [0, 1, 7, 999, 1000, 5000])
def test_equals_rank(spark, k):
    df = rows(spark)
    got = first_in_order(df, "c", hash_key(42, "reading_id"), "reading_id", fixed(k), "f")
    want = plain_rank(df).where(F.col("r") <= k)
    assert got.count() == 3000
    assert sorted(r.reading_id for r in got.where("f").collect()) == sorted(r.reading_id for r in want.collect())


@pytest.mark.parametrize("in_order", [0, 3, 1000])
def test_equal_prefixes(spark, monkeypatch, in_order):
    """Digests that differ only far behind the counted prefix are still told apart."""
    from ferrite.operators import selection
    monkeypatch.setattr(selection, "IN_ORDER", in_order)
    df = spark.createDataFrame([(i, "a") for i in range(50)], "reading_id BIGINT, c STRING")
    order = F.concat(F.lit("01234567"), F.lpad((F.lit(99) - F.col("reading_id")).cast("string"), 4, "0"))
    got = first_in_order(df, "c", order, "reading_id", fixed(8), "f").where("f")
    assert sorted(r.reading_id for r in got.collect()) == list(range(42, 50))


def test_repeated_and_null_keys_stay_together(spark):
    data = [(1, "a")] * 400 + [(None, "a")] * 3 + [(i, "a") for i in range(2, 200)] + [(5, None)]
    df = spark.createDataFrame(data, "reading_id BIGINT, c STRING")
    got = first_in_order(df, "c", hash_key(42, "reading_id"), "reading_id", fixed(100), "f")
    parts = got.groupBy("reading_id").agg(F.count_distinct("f").alias("n"), F.max("f").alias("f")).collect()
    assert got.count() == len(data) - 1 and all(p.n == 1 for p in parts)
    assert next(p.f for p in parts if p.reading_id is None)  # a null key comes first
    assert got.where("f").count() >= 100


def test_empty(spark):
    assert S.stratified_split(rows(spark, 0), "c").count() == 0
    assert R.undersample(rows(spark, 0), "c").count() == 0
    assert R.oversample(rows(spark, 0), "c").count() == 0


def test_no_row_is_exchanged(spark):
    df = rows(spark).withColumn("wide", F.concat(F.lit("payload"), F.col("reading_id").cast("string")))
    for q in (S.stratified_split(df, "c"), R.undersample(df, "c"), R.oversample(df, "c")):
        physical = q._jdf.queryExecution().executedPlan().toString()
        assert "wide" in physical and "BroadcastHashJoin" in physical
        assert "Exchange hashpartitioning" not in physical and "Exchange rangepartitioning" not in physical
