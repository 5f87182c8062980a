import math

import pytest
from pyspark.sql import functions as F

from ferrite.llm.sharding import communication_matrix, uniform_shards, with_hypergeometric


@pytest.mark.parametrize("n", [0, 1, 5, 40, 333])
def test_sizes_and_slots(spark, n):
    rows = uniform_shards(spark.range(n).selectExpr("id", "id as Shard"), 4, block_rows=16).collect()
    slots = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(4)}
    assert sorted(r.id for r in rows) == list(range(n))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(v == list(range(len(v))) for v in slots.values())


def test_null_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a")] * 7 + [(1, None)] * 30 + [(2, "b")], "doc_id long, slot string")
    rows = uniform_shards(df, 3, block_rows=8).collect()
    assert sorted(sum(r.shard == s for r in rows) for s in range(3)) == [12, 13, 13]
    assert sum(r.doc_id == 1 for r in rows) == 30


def test_matrix_keeps_its_margins(spark):
    sizes = {0: 10, 1: 0, 2: 25, 3: 7, 5: 40, 6: 1, 7: 17}
    table = spark.createDataFrame([(b, n) for b, n in sizes.items() if n], "block long, n long")
    rows = {r.block: r.quota for r in communication_matrix(table, [34, 33, 33], 3, 4).collect()}
    assert {b: sum(q) for b, q in rows.items()} == {**{b: 0 for b in range(8)}, **sizes}
    assert [sum(q[s] for q in rows.values()) for s in range(3)] == [34, 33, 33]


def test_draws_follow_the_law(spark):
    draws = spark.range(20000).selectExpr("7L _n", "5L _good", "9L _bad").withColumn("_u", F.rand(3))
    seen = {r.k: r["count"] / 20000 for r in with_hypergeometric(draws, "k").groupBy("k").count().collect()}
    for k in range(6):
        want = math.comb(5, k) * math.comb(9, 7 - k) / math.comb(14, 7)
        assert abs(seen.get(k, 0) - want) < 0.015


def test_any_row_reaches_any_shard_evenly(spark):
    hits = [0] * 4
    for seed in range(6):
        for r in uniform_shards(spark.range(200), 4, seed=seed * 10, block_rows=32).collect():
            hits[r.shard] += r.id < 50
    assert all(abs(h - 75) < 35 for h in hits)
