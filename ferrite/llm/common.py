"""Helpers shared by the operators: table reads, batch functions, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ferrite.session import materialize

# Arrow batches that feed Python are cut by rows and by bytes, so that a run
# of very long texts cannot fill a Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns named in ``names`` in any case: results of an
    operator replace input columns of the same name."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def append_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField],
                   start: Callable[[], Callable[..., list]]) -> DataFrame:
    """Every row of ``df`` with ``fields`` appended, batch by batch in Python.

    ``start()`` runs once in each task and returns ``f(*columns)``: given the
    Arrow arrays of the ``inputs`` columns of a batch it returns one list per
    field.  An input column named like a field (in any case) is replaced by
    it.  No rows are dropped or reordered, and there is no shuffle.
    """
    small_batches(df.sparkSession)
    taken = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in taken]
    need = keep + [c for c in inputs if c not in keep]
    arrow_types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = start()
        for batch in batches:
            columns = dict(zip(need, batch.columns))
            made = f(*[columns[c] for c in inputs])
            yield pa.RecordBatch.from_arrays(
                [columns[c] for c in keep] + [pa.array(v, t) for v, t in zip(made, arrow_types)],
                names=[*keep, *[x.name for x in fields]])

    schema = T.StructType([df.schema[c] for c in keep] + fields)
    return df.select(*[df[f"`{c}`"] for c in need]).mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


# ---- groups of bounded size, links and components --------------------------

def bounded_shards(members: DataFrame, key: str, order: str, limit: int, counted: DataFrame | None = None) -> DataFrame:
    """``members`` of keys with two rows or more, with ``_i``, ``_k`` and ``_slice``.

    A key with more than ``limit`` rows is cut into slices by a hash of
    ``order``, and a member of slice s goes to one shard (_i, _k) for each
    other slice: any two members of a key meet in a shard, and a shard holds
    about twice ``limit`` rows at most.  Other keys are one shard (0, 0).
    ``counted`` has the same keys as often, where ``members`` is dear to make twice.
    """
    sizes = (members if counted is None else counted).groupBy(key).agg(F.count("*").alias("_size")).filter("_size > 1")
    g = F.ceil(F.col("_size") / limit)
    cut = members.join(sizes, key).withColumn("_g", g.cast("int")).withColumn(
        "_slice", F.pmod(F.xxhash64(F.col(order), F.lit(1)), F.col("_g")).cast("int"))
    return cut.withColumn("_with", F.explode(F.expr("sequence(0, _g - 1)"))).withColumns({
        "_i": F.least("_slice", "_with"), "_k": F.greatest("_slice", "_with")}).drop("_size", "_g", "_with")


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b: long): the least node reachable.

    Large-star and small-star rounds over the table of links: each round joins
    links to the least neighbour of their node, so the number of rounds grows
    with the logarithm of the longest chain.  Each round is written to the
    shared folder.  Nothing but a count and a checksum comes to the driver.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    now = materialize(tidy(links), "links")
    mark = state(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = tidy(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = materialize(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        now = materialize(tidy(small), "links")
        before, mark = mark, state(now)
        if mark == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


# ---- word hashes over bytes ------------------------------------------------

_P = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_SEGMENT = 1 << 20
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def byte_class(is_word: Callable[[int], bool]) -> np.ndarray:
    return np.array([is_word(b) for b in range(256)], bool)


# Digits, letters and every byte of a character beyond ASCII.
WORD_BYTES = byte_class(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


def segments(data: bytes, words: np.ndarray, size: int = _SEGMENT) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes (longer only where one word is), no word cut."""
    at = 0
    while at < len(data):
        stop = min(len(data), at + size)
        while stop < len(data) and words[data[stop]] and words[data[stop - 1]]:
            stop += 1
        yield data[at:stop] if at or stop < len(data) else data
        at = stop


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, base, np.uint64))))


_POW, _INV = _powers(_P, 1 << 16), _powers(_P_INV, 1 << 16)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: bytes, words: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (byte offsets) and 64-bit hashes of the A-Z-lowered words.

    Works in segments of about 1 MB (longer only where one word is), so the
    memory for a very long text is a few times its size.
    """
    global _POW, _INV
    buf = np.frombuffer(data, np.uint8)
    starts, ends, hashes = [], [], []
    at = 0
    while at < len(buf):
        stop = min(len(buf), at + _SEGMENT)
        while stop < len(buf) and words[buf[stop]] and words[buf[stop - 1]]:
            stop += 1
        part = buf[at:stop]
        inside = words[part].astype(np.int8)
        edges = np.diff(np.concatenate(([0], inside, [0])))
        s, e = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        if len(part) >= len(_POW):
            _POW, _INV = _powers(_P, 2 * len(part)), _powers(_P_INV, 2 * len(part))
        with np.errstate(over="ignore"):
            sums = np.concatenate(([np.uint64(0)], np.cumsum((LOWER[part].astype(np.uint64) + np.uint64(1)) * _POW[:len(part)])))
            h = mixed((sums[e] - sums[s]) * _INV[s])
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(h)
        at = stop
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (none if fewer words)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * np.uint64(_P) + h[j:len(h) - n + 1 + j]
    return mixed(out)
