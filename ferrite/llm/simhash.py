"""SimHash near-duplicates through BK-trees over shards of fingerprints.

Fingerprints that differ in at most r bits agree in at least one of r + 1
bit blocks, so a tree for each (block, value of the block) meets every linked
pair: the shard trees.  Each shard is one BK-tree: a node's children are keyed
by their integer Hamming distance to it, and a search with radius r follows
only the edges between d - r and d + r.  A shard that a hot value makes too
large is cut into slices that meet pairwise (``bounded_shards``).

The trees hold fingerprints of all documents, so they have no size bound and
are not broadcast: the shuffle brings a shard's members to its tree instead.
Equal fingerprints are one member.  A shard gives back a spanning forest
(member, least member of its group), never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, bounded_shards, components, table, utf8
from ferrite.session import materialize

SHINGLE = 3
MAX_BITS = 3
#: Fingerprints in a slice of a hot shard.
SLICE = 512
_BLOCK = 1 << 15  # shingles whose bits are counted at once


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the A-Z-lowered words of UTF-8 ``data``; 0 if there are none."""
    words = data.lower().split()  # bytes: lowers A-Z only, splits at \x20 and \x09-\x0D
    n = max(1, len(words) - shingle + 1)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends))[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    h64 = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        h = np.fromiter((h64(joined[a:b], 42) for a, b in zip(starts[at:at + _BLOCK], stops[at:at + _BLOCK])), np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = SHINGLE, out: str = "simhash") -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as a signed long (null text: 0)."""
    def start():
        def f(texts):
            prints = np.array([fingerprint(t or b"", shingle) for t in utf8(texts)], np.uint64)
            return [prints.view(np.int64)]
        return f

    return append_columns(docs, ["text"], [T.StructField(out, T.LongType())], start)


class BKTree:
    """Integers under Hamming distance; children keyed by the distance to their parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        if self.values:
            at = 0
            while True:
                d = (self.values[at] ^ x).bit_count()
                nxt = self.children[at].get(d)
                if nxt is None:
                    self.children[at][d] = len(self.values)
                    break
                at = nxt
        self.values.append(x)
        self.children.append({})

    def within(self, x: int, radius: int) -> list[int]:
        """Positions of the values at ``radius`` or less from x."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            d = (values[at] ^ x).bit_count()
            if d <= radius:
                found.append(at)
            if children[at]:
                todo.extend(c for e, c in children[at].items() if d - radius <= e <= d + radius)
        return found


def _forest(members: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """(member, another member of its group) for all members that have links."""
    tree, group = BKTree(), list(range(len(members)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i, x in enumerate(members):
        for j in tree.within(x, radius):
            a, b = root(i), root(j)
            group[max(a, b)] = min(a, b)
        tree.add(x)
    for i, x in enumerate(members):
        if (r := root(i)) != i:
            yield x, members[r]


def fingerprint_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect the distinct values of ``simhash`` at ``max_bits`` or fewer.

    The links span every group; within a group not every pair is listed.
    """
    width, blocks = 64 // (max_bits + 1), []
    for j in range(max_bits + 1):
        # the last block takes the bits that are left over
        mask = (1 << (width if j < max_bits else 64 - width * max_bits)) - 1
        part = F.shiftrightunsigned("simhash", j * width).bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))
        blocks.append(F.xxhash64(F.lit(j), part))
    members = prints.select("simhash").distinct().select("simhash", F.explode(F.array(*blocks)).alias("_key"))
    shards = bounded_shards(members, "_key", "simhash", SLICE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members = None, []

        def made(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array([r[i] for r in rows], np.uint64).view(np.int64)) for i in (0, 1)], names=["a", "b"])

        rows = []
        for batch in batches:
            k, i, j, v = (c.to_pylist() for c in batch.columns)
            for shard, x in zip(zip(k, i, j), v):
                if shard != now:
                    rows += _forest(members, max_bits) if len(members) > 1 else ()
                    now, members = shard, []
                    if len(rows) > 10_000:
                        yield made(rows)
                        rows = []
                members.append(x & (1 << 64) - 1)
        rows += _forest(members, max_bits) if len(members) > 1 else ()
        if rows:
            yield made(rows)

    dealt = shards.select("_key", "_i", "_k", "simhash").repartition("_key", "_i", "_k").sortWithinPartitions("_key", "_i", "_k", "simhash")
    return dealt.mapInArrow(run, "a long, b long")


def groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(simhash, component_id): the least doc_id of each fingerprint's group.

    ``prints`` has doc_id and simhash, and is read more than once: pass a
    written table.  Null doc_ids are no ids; a group of them alone gets null.
    """
    found = components(fingerprint_links(prints, max_bits))
    ids = prints.groupBy("simhash").agg(F.min("doc_id").alias("_id")).join(
        found.withColumnRenamed("node", "simhash"), "simhash", "left").withColumn(
        "component", F.coalesce("component", "simhash"))
    ids = materialize(ids, "simhash-groups")
    least = ids.groupBy("component").agg(F.min("_id").alias("component_id"))
    return ids.join(least, "component").select("simhash", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits) and component_id.

    Texts without words (null, empty, blank) have fingerprint zero and are
    linked like any other.  Repeated rows give repeated results.  An empty
    table gives an empty one.  Other columns are not looked at.
    """
    prints = materialize(with_fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", "simhash"), "simhash")
    return prints.join(groups(prints, max_bits), "simhash").select(
        "doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The columns of ``docs`` with one document of each group: that of the least doc_id.

    Rows repeated with the same id and fingerprint count once; a null id
    comes after all others.
    """
    packed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col("doc_id").alias("_id"), "text")
    marked = materialize(with_fingerprints(packed, shingle).drop("text"), "simhash-docs")
    prints = marked.select(F.col("_id").alias("doc_id"), "simhash")
    rows = prints.groupBy("doc_id", "simhash").agg(F.count("*").alias("_rows"))
    found = components(fingerprint_links(prints, max_bits)).withColumnRenamed("node", "simhash")
    labelled = rows.join(found, "simhash", "left").withColumn("component", F.coalesce("component", "simhash"))
    first = labelled.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("_null"), "doc_id", "simhash", "_rows")).alias("x")).select("x.*")
    kept = marked.join(first.select(F.col("doc_id").alias("_first"), "simhash", "_rows"), "simhash").filter("_id <=> _first")
    once = kept.filter("_rows = 1").select("row.*")
    return once.unionByName(kept.filter("_rows > 1").dropDuplicates(["simhash"]).select("row.*"))


def op10_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
