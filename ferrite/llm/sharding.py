"""Uniform shuffle into shards of equal row counts by a hypergeometric matrix.

A uniform random permutation of N rows, cut into S shards, sends from each
source block to each shard a count that follows the multivariate
hypergeometric law.  ``communication_matrix`` draws these counts exactly, with
block sizes and shard sizes as fixed margins: the blocks of a node are split
into halves, and the node's room in each shard is split between the halves.
Each block then permutes its rows on its own and deals the next so-many to
each shard, and each shard permutes what it got.  Shard sizes differ by one
row at most, and the whole is a uniform permutation.

DataFrame expressions only; the matrix is a distributed table of one row per
block, joined to the rows on the block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferrite.llm.common import table, without
from ferrite.session import materialize

#: Rows that a block, or a slice of a shard, holds on average: what one task sorts.
BLOCK_ROWS = 1 << 14
LAW = "rows"


def _unit(*cols: Column) -> Column:
    """A number in (0, 1) that hashes of the columns decide."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") + 0.5) / float(1 << 53)


def with_hypergeometric(df: DataFrame, out: str) -> DataFrame:
    """``df`` with column ``out``: of ``_n`` rows drawn from ``_good + _bad``, how many are good.

    Inversion at ``_u`` in (0, 1) over the values in the order mode, above,
    below.  Weights are products of the law's exact ratios, in units of the
    mode's weight; values beyond 12 standard deviations and 40 steps weigh
    less than a double can show.
    """
    def steps(count: str) -> str:  # 1..count, empty for 0
        return f"slice(sequence(0L, {count}), 2, cast({count} as int))"

    up = "a.w * ((_good - a.k) * 1D * (_n - a.k)) / ((a.k + 1) * 1D * (_bad - _n + a.k + 1))"
    down = "a.w * (a.k * 1D * (_bad - _n + a.k)) / ((_good - a.k + 1) * 1D * (_n - a.k + 1))"

    def total(count: str, move: str, to: str) -> str:
        return (f"aggregate({steps(count)}, named_struct('k', _m, 'w', 1D, 's', 0D), (a, i) -> "
                f"named_struct('k', {to}, 'w', {move}, 's', a.s + {move}), a -> a.s)")

    def found(count: str, move: str, to: str, rest: str) -> str:
        return (f"aggregate({steps(count)}, named_struct('k', _m, 'w', 1D, 't', {rest}, 'hit', cast(null as bigint)), "
                f"(a, i) -> if(a.hit is not null, a, named_struct('k', {to}, 'w', {move}, 't', a.t - {move}, "
                f"'hit', if(a.t < {move}, {to}, cast(null as bigint)))), a -> coalesce(a.hit, _m))")

    pop = "greatest(1L, _good + _bad)"
    sd = f"sqrt(_n * 1D * _good / {pop} * _bad / {pop} * (_good + _bad - _n) / greatest(1L, _good + _bad - 1))"
    return (df
            .withColumns({"_lo": F.expr("greatest(0L, _n - _bad)"), "_hi": F.expr("least(_n, _good)")})
            .withColumns({"_m": F.expr("least(_hi, greatest(_lo, cast(floor((_n + 1D) * (_good + 1D) / (_good + _bad + 2D)) as bigint)))"),
                          "_reach": F.expr(f"cast(ceil(12 * {sd}) as bigint) + 40")})
            .withColumns({"_above": F.expr("least(_reach, _hi - _m)"), "_below": F.expr("least(_reach, _m - _lo)")})
            .withColumns({"_w_above": F.expr(total("_above", up, "a.k + 1")), "_w_below": F.expr(total("_below", down, "a.k - 1"))})
            .withColumn("_t", F.expr("_u * (1D + _w_above + _w_below)"))
            .withColumn(out, F.expr(
                f"case when _t < 1D then _m when _t - 1D < _w_above then {found('_above', up, 'a.k + 1', '_t - 1D')} "
                f"else {found('_below', down, 'a.k - 1', '_t - 1D - _w_above')} end"))
            .drop("_lo", "_hi", "_m", "_reach", "_above", "_below", "_w_above", "_w_below", "_t"))


def _dealt(nodes: DataFrame, n_shards: int, salt: Column) -> DataFrame:
    """``nodes`` (node, cap, n_left) with ``left``: n_left rows drawn from the shards' room ``cap``."""
    total = "aggregate({}, 0L, (a, x) -> a + x)"
    parts = nodes.select("node", F.lit(0).alias("at"), F.col("n_left").alias("_n"), F.col("cap").alias("room"))
    for _ in range(max(0, n_shards - 1).bit_length()):
        half = F.expr("cast((size(room) + 1) div 2 as int)")
        parts = parts.withColumn("_h", half).withColumns({
            "_a": F.expr("slice(room, 1, _h)"), "_b": F.expr("slice(room, _h + 1, size(room) - _h)")})
        parts = parts.withColumns({"_good": F.expr(total.format("_a")), "_bad": F.expr(total.format("_b")),
                                   "_u": _unit(salt, F.col("node"), F.col("at"), F.size("room"))})
        parts = with_hypergeometric(parts, "_k").select("node", F.explode(F.array(
            F.struct("at", F.col("_k").alias("_n"), F.col("_a").alias("room")),
            F.struct((F.col("at") + F.col("_h")).alias("at"), (F.col("_n") - F.col("_k")).alias("_n"),
                     F.col("_b").alias("room")))).alias("x")).select("node", "x.*").filter(F.size("room") > 0)
    left = parts.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("at", "_n"))).alias("left"))
    return nodes.join(left.select("node", F.col("left._n").alias("left")), "node")


def communication_matrix(sizes: DataFrame, capacities: list[int], levels: int, seed: int) -> DataFrame:
    """(block, quota): rows that each of ``2**levels`` blocks sends to each shard.

    ``sizes`` has (block, n); the sum of n equals the sum of ``capacities``.
    Row sums are the block sizes and column sums the capacities, exactly.
    """
    spark = sizes.sparkSession
    nodes = spark.range(1).select(F.col("id").alias("node"),
                                  F.array(*[F.lit(c).cast("long") for c in capacities]).alias("cap"))
    for level in range(1, levels + 1):
        at = F.shiftright("block", levels - level)
        left_sizes = (sizes.filter(at % 2 == 0).groupBy(F.shiftright(at, 1).alias("node"))
                      .agg(F.sum("n").alias("n_left")))
        split = _dealt(nodes.join(left_sizes, "node", "left").fillna(0, ["n_left"]),
                       len(capacities), F.lit(seed * 1009 + level))
        nodes = materialize(split.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("cap")),
            F.struct((F.col("node") * 2 + 1).alias("node"),
                     F.zip_with("cap", "left", lambda c, x: c - x).alias("cap")))).alias("x")).select("x.*"), "matrix")
    return nodes.select(F.col("node").alias("block"), F.col("cap").alias("quota"))


def uniform_shards(df: DataFrame, n_shards: int, seed: int = 17, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with ``shard`` (0 to n_shards-1) and ``slot`` (0, 1, ... within the shard).

    Nulls, ties and repeated rows are ordinary rows, each placed once; an
    empty table gives an empty result; with fewer rows than shards some
    shards stay empty.  Columns of ``df`` named shard or slot are replaced.
    The two random numbers of each row are written with the rows, so all
    that follows reads the same ones, also after a lost executor.
    """
    base = materialize(without(df, ["shard", "slot"]).withColumns({
        "_u1": F.rand(seed), "_u2": F.rand(seed + 1)}), "shard-rows")
    n = base.count()
    levels = max(0, -(-n // block_rows) - 1).bit_length()
    slices = max(1, -(-n // (n_shards * block_rows)))
    base = base.withColumn("block", F.floor(F.col("_u1") * (1 << levels)))
    sizes = base.groupBy("block").agg(F.count("*").alias("n"))
    capacities = [n // n_shards + (s < n % n_shards) for s in range(n_shards)]
    matrix = communication_matrix(materialize(sizes, "shard-blocks"), capacities, levels, seed)
    ends = matrix.withColumn("ends", F.expr(
        "transform(quota, (q, i) -> aggregate(slice(quota, 1, i + 1), 0L, (a, x) -> a + x))")).drop("quota")
    local = F.row_number().over(Window.partitionBy("block").orderBy("_u1", "_u2")) - 1
    sent = (base.withColumn("_at", local).join(ends, "block")
            .withColumn("shard", F.expr("cast(size(filter(ends, e -> e <= _at)) as int)"))
            .withColumn("_slice", F.floor(F.col("_u2") * slices)).drop("block", "_at", "ends"))
    sent = materialize(sent, "shard-sent")
    counts = sent.groupBy("shard", "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # the order within a slice is a third number, so that it does not repeat the local order
    order = Window.partitionBy("shard", "_slice").orderBy(F.xxhash64("_u2", "_u1", F.lit(seed)), "_u1")
    return (sent.withColumn("_rank", F.row_number().over(order) - 1)
            .join(offsets, ["shard", "_slice"])
            .withColumn("slot", (F.col("_before") + F.col("_rank")).cast("long"))
            .drop("_u1", "_u2", "_slice", "_rank", "_before"))


def op1_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts, uniformly shuffled.

    A null text counts as no bytes: size 1, CRC of nothing (0).
    """
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return uniform_shards(rows, 16).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
