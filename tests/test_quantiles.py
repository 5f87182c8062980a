"""Bracketed quantiles against ``percentile`` of the whole group."""

import pytest
from pyspark.sql import functions as F

from ferrite.operators import ordered
from ferrite.operators.ordered import exact_quantiles

PROBS = [0.0, 0.001, 0.25, 0.5, 0.9, 1.0]

# name: an expression of id in 0..39999
SHAPES = {
    "spread": "cast((id * 7919) % 40000 as double) / 7",
    "hot value": "case when id % 3 = 0 then 5.0D else cast((id * 31) % 9973 as double) end",
    "two values": "cast(id % 2 as double)",
    "one value": "3.5D",
    "far apart": "pow(10D, cast((id * 7919) % 600 as double) - 300)",
    "heavy tail": "case when id % 1000 = 0 then 1e300D else cast((id * 17) % 40000 as double) end",
    "infinities": "case when id % 10 < 3 then double('-infinity') when id % 10 < 5 then double('infinity') else cast(id as double) end",
}


def test_equals_percentile(spark):
    df = spark.range(40_000, numPartitions=5)
    long = None
    for name, shape in SHAPES.items():
        one = df.select(F.lit(name).alias("g"), F.expr(shape).alias("v"))
        long = one if long is None else long.unionByName(one)
    long = long.unionByName(spark.createDataFrame([("few", 2.0), ("few", 1.0), ("few", None), ("none", None)], "g STRING, v DOUBLE"))
    got = {r.g: r for r in exact_quantiles(long, ["g"], "v", PROBS).collect()}
    want = long.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in PROBS])).alias("p")).collect()
    assert set(got) == set(SHAPES) | {"few"}
    for r in want:
        for i, p in enumerate(r.p or ()):
            mine = got[r.g][f"q_{i}"]
            assert mine == pytest.approx(p, rel=1e-12) or (mine != mine and p != p), (r.g, PROBS[i])


@pytest.mark.parametrize("in_order", [0, 40, 1_000_000])
def test_coarse_cuts_give_the_same(spark, monkeypatch, in_order):
    """Cuts and the size of cells decide the work, not the answer."""
    df = spark.range(5000).select(F.lit("g").alias("g"), F.expr("case when id % 3 = 0 then 7.0D else cast((id * 3571) % 4999 as double) end").alias("v"))
    want = df.agg(F.percentile("v", F.array(*[F.lit(p) for p in PROBS])).alias("p")).first().p
    monkeypatch.setattr(ordered, "IN_ORDER", in_order)
    for error, margin in ((1 / 20, 0.0), (1 / 20, 0.3)):
        monkeypatch.setattr(ordered, "SKETCH_ERROR", error)
        monkeypatch.setattr(ordered, "CUT_MARGIN", margin)
        assert list(exact_quantiles(df, ["g"], "v", PROBS).first())[1:] == pytest.approx(want, rel=1e-12)


def test_only_cells_are_put_in_order(spark):
    """Of 200,000 distinct values the ordered part sees a small share."""
    n = 200_000
    df = spark.range(n).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % n).cast("double").alias("v"))
    q = exact_quantiles(df, ["g"], "v", [0.5])
    assert q.first().q_0 == (n - 1) / 2
    cells = spark.read.parquet(*[f for f in q.inputFiles() if "/cells-" in f])
    assert cells.agg(F.sum("_size")).first()[0] <= n * 5 * ordered.CUT_MARGIN


def test_empty(spark):
    assert exact_quantiles(spark.createDataFrame([], "g STRING, v DOUBLE"), ["g"], "v", [0.5]).count() == 0
