"""Merkle manifest of a dataset: leaves, subroots, root, proofs and their check.

Every row is a leaf, the SHA-256 (lowercase hex) of its fields.  The leaves of
a partition value (``lang``) ascend by id and are reduced two by two to a
subroot; the subroots, in the order of the values, are reduced likewise to the
root.  H hashes the hex texts of its inputs in turn; a last node alone is
hashed too while more than one node remains.

Cogrouped subtree exchange.  A tree is cut into superblocks of 4,096
consecutive nodes, so a superblock is a subtree of 12 levels whose top is one
node of a tree 4,096 times smaller.  On the way up each superblock
is reduced to that node, until one is left.  On the way down the nodes of a
superblock and the outer nodes that their proofs need (the path from the
superblock's top to the root, one row) are cogrouped in ``applyInPandas``:
there the local reduction is finished, the local siblings are joined with the
outer ones, and each claimed leaf is folded along its proof.

A group holds 4,096 rows at most however many rows one value has.  Ranks
come from range buckets (ids first, then leaves, then a written row number, so
copies of one row are dealt out too).  The sizes of the trees are the only
figures that reach the driver, one number a level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import table
from ferrite.operators.ordered import running_totals
from ferrite.session import materialize

#: Levels of a superblock, which has 2 ** LEVELS nodes.
LEVELS = 12
#: The fields of a leaf, in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduction(nodes: Sequence[str], height: int) -> list[list[str]]:
    """The levels from ``nodes`` up, ``height`` times two by two (a last one alone is hashed too)."""
    levels = [list(nodes)]
    for _ in range(height):
        below = levels[-1]
        levels.append([_hash(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def sibling_path(levels: Sequence[Sequence[str]], at: int) -> list[str]:
    """The sibling on each level: ``<`` and its digest if it stands left, ``>`` right, empty if there is none."""
    path = []
    for level in levels[:-1]:
        other = at ^ 1
        path.append(("<" if other < at else ">") + level[other] if other < len(level) else "")
        at >>= 1
    return path


def folded(leaf: str, path: Sequence[str]) -> str:
    """The root that ``leaf`` gives with the siblings of ``path``."""
    for s in path:
        leaf = _hash(s[1:], leaf) if s[:1] == "<" else _hash(leaf, s[1:])
    return leaf


def _height(size: int, levels: int) -> int:
    """Levels of a superblock in a tree of ``size`` nodes."""
    return min(levels, (int(size) - 1).bit_length())


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The leaf of a row: SHA-256 of its fields, ``-`` for null, else bytes, colon and value."""
    return F.sha2(F.concat(*[_field(changed.get(c, F.col(f"`{c}`"))) for c in FIELDS]), 256)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with _tree) with _pos from 0 in their tree and _size, its rows."""
    written = materialize(rows.withColumns({"_row": F.monotonically_increasing_id(), "_one": F.lit(1).cast("long")}), "merkle-rows")
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked, sizes = running_totals(written, ["_tree"], [F.col(c) for c in (*order, "_row")], ["_one"], n_buckets=buckets, return_totals=True)
    return materialize(ranked.join(sizes.withColumnRenamed("_one", "_size"), "_tree").withColumn("_pos", F.col("cum__one") - 1)
                       .drop("_one", "_row", "cum__one"), "merkle-leaves")


_NODE = "_tree string, _pos long, _size long, _digest string"


_OUTER = "_tree string, _block long, _subroot string, _root string, _path array<string>"


def _in_blocks(nodes: DataFrame, levels: int):
    return nodes.withColumn("_block", F.shiftright("_pos", levels)).groupBy("_tree", "_block")


def _climbed(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """The leaves, then the tops of their superblocks, and so on up to one node for each tree."""
    def top(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("_pos")
        size = int(nodes["_size"].iloc[0])
        digest = reduction(nodes["_digest"].tolist(), _height(size, levels))[-1][0]
        return pd.DataFrame({"_tree": [key[0]], "_pos": [int(key[1])], "_size": [-(-size >> levels)], "_digest": [digest]})

    stories = [leaves.select("_tree", "_pos", "_size", "_digest")]
    while (stories[-1].agg(F.max("_size")).first()[0] or 1) > 1:
        stories.append(materialize(_in_blocks(stories[-1], levels).applyInPandas(top, _NODE), "merkle-nodes"))
    return stories


def _with_paths(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int) -> tuple[pd.DataFrame, pd.Series, list[list[str]]]:
    """A superblock's nodes in order, its outer row and each node's path to the root."""
    nodes, end = nodes.sort_values("_pos"), outer.iloc[0]
    local, beyond = reduction(nodes["_digest"].tolist(), _height(nodes["_size"].iloc[0], levels)), list(end["_path"])
    return nodes, end, [[*sibling_path(local, i), *beyond] for i in range(len(nodes))]


def _descended(stories: list[DataFrame], ends: DataFrame, levels: int) -> DataFrame:
    """(_tree, _block, _path, _subroot, _root) for the superblocks of the first story; ``ends`` has them for the last."""
    def joined(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, end, paths = _with_paths(nodes, outer, levels)
        return pd.DataFrame({"_tree": key[0], "_block": nodes["_pos"].array, "_subroot": end["_subroot"], "_root": end["_root"], "_path": paths})

    outer = ends
    for nodes in reversed(stories[1:-1]):
        outer = materialize(_in_blocks(nodes, levels).cogroup(outer.groupBy("_tree", "_block")).applyInPandas(joined, _OUTER), "merkle-outer")
    return outer


def manifest(rows: DataFrame, id_col: str = "doc_id", paths: bool = True, levels: int = LEVELS) -> DataFrame:
    """Proof and its check for each row of ``rows`` (``id_col``, ``tree``, ``leaf``, ``claim``).

    Leaves of one ``tree`` (a string; null is a value of its own, before all
    others) ascend by id (null first), equal ids by leaf; rows that are alike
    stand side by side and have a proof each.  ``claim`` is the leaf that is
    checked, say one made of the row as it is now.  Returns ``id_col``, leaf,
    claim, subroot, root, path (with ``paths``; the siblings up to the root,
    see ``sibling_path``), proof_sha256 (of the siblings' digests in turn),
    folded_root and verified.  ``levels`` sets the size of superblocks, not
    the result.  No rows give no rows.
    """
    leaves = _ranked(rows.select(F.col(f"`{id_col}`").alias("_id"), "leaf", "claim",
                                 F.coalesce(F.concat(F.lit("="), F.col("tree")), F.lit("")).alias("_tree")), ["_id", "leaf"])
    # pandas has no integers with nulls: ids travel as text
    leaves = leaves.withColumnRenamed("leaf", "_digest").withColumn("_id", F.col("_id").cast("string"))
    stories = _climbed(leaves, levels)
    # the subroots are the leaves of one more tree
    subroots = _ranked(stories[-1].select(F.lit("").alias("_tree"), F.col("_tree").alias("_of"), "_digest"), ["_of"])
    upper = _climbed(subroots, levels)
    top = upper[-1].select("_tree", F.lit(0).cast("long").alias("_block"), F.lit(None).cast("string").alias("_subroot"),
                           F.col("_digest").alias("_root"), F.array().cast("array<string>").alias("_path"))

    def ends(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, end, found = _with_paths(nodes, outer, levels)
        return pd.DataFrame({"_tree": nodes["_of"].array, "_block": 0, "_subroot": nodes["_digest"].array, "_root": end["_root"], "_path": found})

    def proved(key: tuple, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes, end, found = _with_paths(nodes, outer, levels)
        roots = [folded(c, p) for c, p in zip(nodes["claim"], found)]
        out = {"_id": nodes["_id"].array, "leaf": nodes["_digest"].array, "claim": nodes["claim"].array,
               "subroot": end["_subroot"], "root": end["_root"],
               "proof_sha256": [_hash(*[s[1:] for s in p]) for p in found],
               "folded_root": roots, "verified": [r == end["_root"] for r in roots]}
        return pd.DataFrame({**out, "path": found} if paths else out)

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("_id", "leaf", "claim", "subroot", "root", "proof_sha256", "folded_root")] + [
        T.StructField("verified", T.BooleanType())] + ([T.StructField("path", T.ArrayType(T.StringType()))] if paths else []))
    outer = _descended(upper, top, levels).groupBy("_tree", "_block")
    outer = materialize(_in_blocks(subroots, levels).cogroup(outer).applyInPandas(ends, _OUTER), "merkle-outer")
    outer = _descended(stories, outer, levels).groupBy("_tree", "_block")
    out = _in_blocks(leaves, levels).cogroup(outer).applyInPandas(proved, schema)
    return out.select(F.col("_id").cast(rows.schema[id_col].dataType).alias(id_col), *out.columns[1:])


def tampered(docs: DataFrame) -> DataFrame:
    """``manifest``'s rows of documents; where 7 divides the CRC-32 of the id, one is added to the claim's n_chars.

    A null id has no CRC-32 and is left as it is, and so is a null n_chars.
    """
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return docs.select("doc_id", F.col("lang").cast("string").alias("tree"), leaf().alias("leaf"),
                       F.when(hit, leaf(n_chars=F.col("n_chars") + 1)).otherwise(leaf()).alias("claim"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and check of every document, one in seven tampered with."""
    return manifest(tampered(table(spark, sf_dir, "documents")), paths=False).drop("claim")


#: DuckDB twin of op11_merkle_manifest: the trees as a recursion over levels.
SQL = r"""
with recursive crc as (
  select doc_id, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)) as c
  from (select distinct doc_id from documents where doc_id is not null)),
rows_ as (
  select doc_id, lang, row_number() over () as k, xor(crc.c, 4294967295) % 7 = 0 as hit,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') as head,
    coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as chars,
    coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') as more,
    coalesce(strlen(text) || ':' || text, '-') as tail
  from documents left join crc using (doc_id)),
leaves as (select doc_id, k, coalesce('=' || lang, '') as tree, sha256(head || chars || tail) as leaf,
    sha256(head || case when hit then more else chars end || tail) as claim from rows_),
ranked as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf, k) - 1 as pos,
    count(*) over (partition by tree) as size from leaves),
nodes as (
  select tree, 0 as level, pos::bigint as pos, size::bigint as size, leaf as digest from ranked
  union all
  select tree, level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(digest, '' order by pos)) from nodes
  where size > 1 group by tree, level, size, pos // 2),
subroots as (select tree as of_, digest, row_number() over (order by tree) - 1 as pos, count(*) over () as size from nodes where size = 1),
upper as (
  select 0 as level, pos::bigint as pos, size::bigint as size, digest from subroots
  union all
  select level + 1, pos // 2, (size + 1) // 2, sha256(string_agg(digest, '' order by pos)) from upper
  where size > 1 group by level, size, pos // 2),
heights as (select tree, max(level) as height from nodes group by tree),
steps as (
  select r.k, l.level, case when xor(r.pos >> l.level, 1) < (r.pos >> l.level) then '<' else '>' end as side, s.digest
  from ranked r join heights h using (tree), lateral (select unnest(range(0, h.height)) as level) l
  left join nodes s on s.tree = r.tree and s.level = l.level and s.pos = xor(r.pos >> l.level, 1)
  union all
  select r.k, 1000 + l.level, case when xor(b.pos >> l.level, 1) < (b.pos >> l.level) then '<' else '>' end, s.digest
  from ranked r join subroots b on b.of_ = r.tree, lateral (select unnest(range(0, (select max(level) from upper))) as level) l
  left join upper s on s.level = l.level and s.pos = xor(b.pos >> l.level, 1)),
paths as (select k, list(case when digest is null then '' else side || digest end order by level) as path,
    coalesce(string_agg(digest, '' order by level), '') as siblings from steps group by k),
folded as (
  select r.doc_id, r.leaf, b.digest as subroot, (select digest from upper where size = 1) as root,
    sha256(coalesce(p.siblings, '')) as proof_sha256,
    list_reduce(list_prepend(r.claim, coalesce(p.path, [])), lambda a, s: case when s[1] = '<' then sha256(s[2:] || a)
      when s[1] = '>' then sha256(a || s[2:]) else sha256(a) end) as folded_root
  from ranked r join subroots b on b.of_ = r.tree left join paths p using (k))
select *, folded_root = root as verified from folded
"""
