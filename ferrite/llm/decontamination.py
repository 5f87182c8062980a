"""Benchmark decontamination by a broadcast set of normalised n-gram hashes.

A document's words are hashed in numpy; every window of its words is looked
up in the sorted hashes of the benchmark's windows; a found window is compared
word by word, so a hash collision marks nothing.  Words inside any verified
window are hit.

The benchmark travels as a broadcast of whole items, in blocks of at most
``BLOCK_BYTES`` of text, measured before a block is collected.  A larger
benchmark becomes more blocks, each one more pass of the same rows through
Python, without a shuffle; between passes the rows are written with their
marks, so that one block at a time is in memory.  A worker builds the index of
a block once.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, table, utf8, window_hashes, word_hashes
from ferrite.session import materialize

NGRAM = 13
#: Benchmark text in one broadcast.
BLOCK_BYTES = 16 << 20
#: A document is contaminated if one word in so many is hit.
ONE_IN = 20

_RANGE = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


class _Windows:
    """The different windows of a block of items, by length, sorted by hash.

    A window that an item or several items repeat is kept once, with the list
    of its items, so neither repeats in items nor in documents are compared
    pairwise.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], ngram: int):
        found = defaultdict(list)
        self.ids = [i for i, _ in items]
        self.words = []
        for at, (_, data) in enumerate(items):
            lowered = data.lower()
            starts, ends, h = word_hashes(data)
            self.words.append((lowered, starts, ends))
            n = min(ngram, len(h))
            if n:
                w = window_hashes(h, n)
                found[n].append((w, np.full(len(w), at), np.arange(len(w))))
        self.by_length = {n: self._different(n, *(np.concatenate(x) for x in zip(*parts))) for n, parts in found.items()}

    def _different(self, n: int, w: np.ndarray, at: np.ndarray, first: np.ndarray) -> tuple:
        """(hash, item and place of one occurrence, first of its items in ``of``) of each window, and ``of``."""
        order = np.lexsort((at, w))
        w, at, first = w[order], at[order], first[order]
        one, of = [], []  # window: its occurrence; (window, item)
        new = np.concatenate(([True], w[1:] != w[:-1]))
        single = new & np.concatenate((new[1:], [True]))
        same: list[tuple[int, list[bytes]]] = []  # windows of the present hash
        for i in range(len(w)) if not single.all() else ():
            if single[i]:
                of.append((len(one), int(at[i])))
                one.append(i)
                continue
            if new[i]:
                same = []
            words = self._span(int(at[i]), int(first[i]), n)
            k = next((k for k, x in same if x == words), None)
            if k is None:
                k = len(one)
                same.append((k, words))
                one.append(i)
            of.append((k, int(at[i])))
        if single.all():
            return w, at, first, np.arange(len(w) + 1), at
        pairs = np.unique(np.array(of), axis=0)
        return w[one], at[one], first[one], np.searchsorted(pairs[:, 0], np.arange(len(one) + 1)), pairs[:, 1]

    def _span(self, at: int, first: int, n: int) -> list[bytes]:
        data, s, e = self.words[at]
        return [data[a:b] for a, b in zip(s[first:first + n].tolist(), e[first:first + n].tolist())]

    def hits(self, data: bytes, starts, ends, h) -> tuple[np.ndarray, set[int]]:
        """Which words are hit, and by which items (their positions in the block)."""
        hit, items = np.zeros(len(h) + 1, np.int64), set()
        lowered = None
        for n, (known, at, first, begin, of) in self.by_length.items():
            w = window_hashes(h, n)
            lo = np.searchsorted(known, w, "left")
            maybe = np.flatnonzero((lo < len(known)) & (known[np.minimum(lo, len(known) - 1)] == w))
            if not len(maybe):
                continue
            hi = np.searchsorted(known, w[maybe], "right")
            lowered = lowered if lowered is not None else data.lower()
            seen: dict[int, list[tuple[list[bytes], bool]]] = {}  # by hash: the document's windows so far, and whether known
            for p, a, b in zip(maybe.tolist(), lo[maybe].tolist(), hi.tolist()):
                words = [lowered[s:e] for s, e in zip(starts[p:p + n].tolist(), ends[p:p + n].tolist())]
                before = seen.setdefault(a, [])
                found = next((x for ws, x in before if ws == words), None)
                if found is None:
                    same = [k for k in range(a, b) if self._span(int(at[k]), int(first[k]), n) == words]
                    found = bool(same)
                    before.append((words, found))
                    for k in same:
                        items.update(of[begin[k]:begin[k + 1]].tolist())
                if found:
                    hit[p] += 1
                    hit[p + n] -= 1
        return np.cumsum(hit)[:-1] > 0, items


_INDEX: dict[str, _Windows] = {}  # a worker keeps the index of the block it works on


def _index(name: str, items: list, ngram: int) -> _Windows:
    if name not in _INDEX:
        _INDEX.clear()
        _INDEX[name] = _Windows(items, ngram)
    return _INDEX[name]


def _blocks(benchmark: DataFrame, block_bytes: int):
    """The benchmark's distinct (id, text) in lists of at most ``block_bytes`` of text (or of one item)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("binary").alias("text")).filter("text is not null")
    yield from _cut(materialize(items.distinct(), "benchmark"), block_bytes, 0)


def _cut(items: DataFrame, block_bytes: int, level: int):
    """``items`` in lists, cut by a hash again until the measured bytes of each fit."""
    total, n = items.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if n <= 1 or total <= block_bytes:
        yield [(r.id, bytes(r.text)) for r in items.collect()]
        return
    parts = -(-5 * total // (4 * block_bytes))  # a quarter more, so that most fit at once
    for b in range(parts):
        yield from _cut(items.filter(F.pmod(F.xxhash64("id", "text", F.lit(level)), F.lit(parts)) == b), block_bytes, level + 1)


def scan(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids, hit_ranges and contaminated.

    ``hit_ranges`` holds the code point ranges (end exclusive) of runs of hit
    words.  A null or empty text has no words and is clean; items with null or
    wordless text match nothing; an item with a null id marks words but is
    not listed; equal items are listed under each of their ids.  Columns of
    ``docs`` with these names are replaced.  An empty benchmark hits nothing.
    """
    out, before = docs, None
    blocks = iter(_blocks(benchmark, block_bytes))
    items = next(blocks)
    while items is not None:
        following = next(blocks, None)
        shared = docs.sparkSession.sparkContext.broadcast(items)
        marked = _scan_block(out, shared, ngram, before is None, following is None)
        if following is not None:  # one block at a time is alive: its marks are written, its copies dropped
            marked = materialize(marked, "marks")
            shared.unpersist()
        out, before, items = marked, shared, following
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 and {ONE_IN} * n_hit >= n_words"))


def _scan_block(docs: DataFrame, shared, ngram: int, first: bool, last: bool) -> DataFrame:
    """One block: marks so far come in ``_marks`` (first and end word, in turn) and ``_items``."""
    if last:
        fields = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
                  T.StructField("n_items", T.LongType()), T.StructField("item_ids", T.ArrayType(T.StringType())),
                  T.StructField("hit_ranges", _RANGE)]
    else:
        fields = [T.StructField("_marks", T.ArrayType(T.LongType())), T.StructField("_items", T.ArrayType(T.StringType()))]

    name = uuid.uuid4().hex

    def start():
        windows = _index(name, shared.value, ngram)

        def f(texts, marks=None, known=None):
            rows = []
            marks = marks.to_pylist() if marks is not None else [()] * len(texts)
            known = known.to_pylist() if known is not None else [()] * len(texts)
            for data, before, names in zip(utf8(texts), marks, known):
                data = data or b""
                starts, ends, h = word_hashes(data)
                hit, items = windows.hits(data, starts, ends, h)
                for a, b in zip(before[::2], before[1::2]):
                    hit[a:b] = True
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                ids = sorted({*names, *(windows.ids[i] for i in items if windows.ids[i] is not None)})
                if not last:
                    rows.append((edges.tolist(), ids))
                    continue
                ranges, seen, chars = [], 0, 0
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    s, e = int(starts[a]), int(ends[b - 1])
                    left = chars + len(data[seen:s].decode())
                    chars, seen = left + len(data[s:e].decode()), e
                    ranges.append({"start": left, "end": chars})
                rows.append((len(h), int(hit.sum()), len(ids), ids, ranges))
            return list(zip(*rows)) if rows else [[] for _ in fields]
        return f

    out = append_columns(docs, ["text"] if first else ["text", "_marks", "_items"], fields, start)
    return out.drop("_marks", "_items") if last else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """The columns of ``docs`` without contaminated documents, or with their hit spans cut out.

    Null, empty and wordless texts are clean and stay; repeated rows share
    their verdict; very long texts are scanned whole; no rows give no rows.

    ``remove="spans"`` keeps every document and deletes the hit ranges from
    its text (``n_chars``, if there, is set anew).
    """
    found = scan(docs, benchmark)
    if remove == "documents":
        return found.filter("not contaminated").select(*docs.columns)
    if remove != "spans":
        raise ValueError("remove: 'documents' or 'spans'")
    kept = F.expr("""if(size(hit_ranges) = 0, text, concat_ws('', transform(hit_ranges, (r, i) ->
        substring(text, cast(if(i = 0, 0, hit_ranges[greatest(i - 1, 0)].end) + 1 as int),
                  cast(r.start - if(i = 0, 0, hit_ranges[greatest(i - 1, 0)].end) as int))),
        substring(text, cast(hit_ranges[size(hit_ranges) - 1].end + 1 as int))))""")
    out = found.withColumn("text", kept)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of all documents; items_sha256 is over the ids sorted as strings."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


#: DuckDB twin of op3_decontaminate.
SQL = r"""
with low as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as a, 'abcdefghijklmnopqrstuvwxyz' as b, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' as word),
d as (select doc_id, row_number() over () as k, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents, low),
items as (select id, ws, least(13, len(ws)) as n from (
  select item_id::varchar as id, regexp_extract_all(translate(text, a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark, low)
  where len(ws) > 0),
known as (select distinct id, n, array_to_string(ws[i:i + n - 1], ' ') as g from items, lateral (select unnest(range(1, len(ws) - n + 2)) as i)),
windows as (select k, i, n, array_to_string(ws[i:i + n - 1], ' ') as g from d, (select distinct n from known), lateral (select unnest(range(1, len(ws) - n + 2)) as i)),
found as (select k, i, n, id from windows join known using (n, g)),
hits as (select k, count(distinct i + j) as n_hit from (select distinct k, i, n from found), lateral (select unnest(range(0, n)) as j) group by k),
ids as (select k, count(id) as n_items, coalesce(string_agg(id, ',' order by id), '') as listed from (select distinct k, id from found) group by k)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit > 0 and 20 * n_hit >= len(ws), false) as contaminated
from d left join hits using (k) left join ids using (k)
"""
