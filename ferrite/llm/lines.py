"""Line deduplication by an exact set-similarity join, in DataFrame expressions.

A line is the set of its five-word shingles (a line of fewer words is one
token: itself).  Lines of equal words are one class.  Classes with Jaccard
similarity of 0.8 or more are linked; a line goes if an earlier line is in its
class or in a linked one.

The join.  Tokens are ordered by rarity: a table of ``BUCKETS`` token counts
gives each token a rank, the hash breaks ties, and rank and hash make one
number, so sorting the numbers sorts by rarity.  Two sets that reach the
threshold share a token in their prefixes (prefix filter).  Only prefix
tokens of two classes or more go on, and of tokens that the same classes share
only the first.  In the list of a token, the length filter and the positional
filter drop pairs before their Jaccard similarity is computed on the whole
sets.  A pair is handled in the list of the first token it shares.

A list gives each member a count of links, whether an earlier line is linked,
and a group label: no pairs leave a list.  Long lists are cut into slices that
meet pairwise.  Sets travel only for classes that share a prefix token.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrite.llm.common import bounded_shards, components, table
from ferrite.session import materialize

SHINGLE = 5
#: Buckets of the token counts that rarity is read from.
BUCKETS = 1 << 16
#: Classes in a slice of a long list.
SLICE = 128
#: Bytes of tokens or document keys that may be broadcast; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20

# The blanks that part words, in one SQL string.
_BLANKS = "concat(' \t\r', decode(unhex('0B0C'), 'UTF-8'))"


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, h, line_no, line) of every line with words; ``h`` tells texts of one id apart.

    ``line`` is in lower case, its words parted by one blank.  Most lines are
    so but for the case, and a search for what is not is cheaper than a
    replacement: whole texts are lowered and searched, and the lines only of
    those with a find.  Blank lines go by their raw text, so that the filter
    does not repeat the rest.
    """
    # a select of its own: what stands beside posexplode is computed once for each line
    texts = docs.select("doc_id", F.xxhash64("text").alias("h"), F.expr(_other_blanks("text")).alias("odd"), F.lower("text").alias("low"))
    raw = texts.select("doc_id", "h", "odd", F.posexplode(F.split("low", "\n")).alias("line_no", "raw"))
    return _normalised(raw.filter(F.expr(f"btrim(raw, {_BLANKS}) <> ''")))


def _other_blanks(column: str) -> str:
    return "(" + " or ".join(f"contains({column}, {b})" for b in (
        r"'\t'", r"'\r'", "decode(unhex('0B'), 'UTF-8')", "decode(unhex('0C'), 'UTF-8')", "'  '")) + ")"


def _normalised(lines: DataFrame) -> DataFrame:
    """``line`` for ``raw``, which is in lower case; ``odd``: its text has blanks that lines do not keep."""
    return lines.withColumn("line", F.expr(f"""if((odd and {_other_blanks('raw')}) or startswith(raw, ' ') or endswith(raw, ' '),
        trim(regexp_replace(raw, concat('[', {_BLANKS}, ']+'), ' ')), raw)""")).drop("raw", "odd")


def _hashed_words(lines: DataFrame) -> DataFrame:
    return lines.withColumn("words", F.expr("transform(split(line, ' '), w -> xxhash64(w))")).drop("line")


_SHINGLE_HASH = "xxhash64(" + ", ".join(f"words[i + {j}]" for j in range(SHINGLE)) + ")"
_PLACES = f"if(size(words) < {SHINGLE}, cast(array() as array<int>), sequence(0, size(words) - {SHINGLE}))"


def _ranks(docs: DataFrame) -> str:
    """A SQL array of the ranks of the token buckets: 64 log2 of the bucket's count."""
    counts = (_hashed_words(_lines(docs).select("line")).select("words", F.explode(F.expr(_PLACES)).alias("i"))
              .groupBy(F.expr(f"cast({_SHINGLE_HASH} & {BUCKETS - 1} as int)").alias("bucket")).agg(F.count("*").alias("n")))
    ranks = [0] * BUCKETS
    for r in counts.collect():  # BUCKETS rows at most
        ranks[r.bucket] = int(64 * math.log2(r.n))
    return f"cast(split('{','.join(map(str, ranks))}', ',') as array<int>)"


def _with_keys(lines: DataFrame, ranks: str) -> DataFrame:
    """``keys``: the set of a line, rarest first; rank above, 48 bits of the hash below.

    A line of fewer words than a shingle matches only its equals, which the
    class holds already: its set is left empty.
    """
    tokens = f"transform({_PLACES}, i -> {_SHINGLE_HASH})"
    # never null, as far as types tell: so the sets are sorted as plain numbers
    key = (f"transform({tokens}, t -> shiftleft(cast(coalesce({ranks}[cast(t & {BUCKETS - 1} as int)], 0) as bigint), 48)"
           f" | shiftrightunsigned(t, 16))")
    return _hashed_words(lines).withColumn("keys", F.sort_array(F.array_distinct(F.expr(key)))).drop("words")


def _names() -> list[Column]:
    """128 bits that name a line's class: the normalised line."""
    return [F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(7), "line").alias("k2")]


def _place() -> Column:
    """The order of lines: by doc_id (null last), text, line."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "line_no")


def _classes(docs: DataFrame, ranks: str) -> DataFrame:
    """(node, k1, k2, first, copies, prefix) of each class, written."""
    prefix = F.expr("slice(keys, 1, if(size(keys) = 0, 0, size(keys) - (4 * size(keys) + 4) div 5 + 1))")
    lines = _lines(docs).select(*_names(), _place().alias("place"), "line")
    found = (_with_keys(lines, ranks).select("k1", "k2", "place", prefix.alias("prefix"))
             .groupBy("k1", "k2").agg(F.min("place").alias("first"), F.count("*").alias("copies"), F.first("prefix").alias("prefix")))
    return materialize(found.withColumn("node", F.monotonically_increasing_id()), "line-classes")


def _lists(classes: DataFrame) -> DataFrame:
    """(key, node): lists of classes that share a prefix token, one for each different list."""
    prefixes = classes.select("node", F.explode("prefix").alias("key"))
    shared = materialize(prefixes.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1").select("key"), "line-tokens")
    if shared.count() * 8 <= BROADCAST_BYTES:  # else the prefixes move to their tokens
        shared = F.broadcast(shared)
    lists = materialize(prefixes.join(shared, "key"), "line-lists")
    same = lists.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                    F.sum(F.hash("node").cast("long")).alias("s"))
    return lists.join(same.groupBy("n", "x", "s").agg(F.min("key").alias("key")).select("key"), "key")


def _sets(docs: DataFrame, classes: DataFrame, lists: DataFrame, ranks: str) -> DataFrame:
    """(node, first, copies, keys) of the classes in lists: their first lines, read again."""
    wanted = classes.join(lists.select("node").distinct(), "node").select("node", "first", "copies")
    by_doc = materialize(wanted.groupBy("first.doc_id", "first.h").agg(
        F.collect_list(F.struct("first.line_no", "node", "copies")).alias("wanted")), "line-wanted")
    size = by_doc.agg(F.sum(F.size("wanted") * 20 + 40)).first()[0] or 0
    side = F.broadcast(by_doc) if size <= BROADCAST_BYTES else by_doc
    text = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").alias("t")
    raw = text.join(side.alias("w"), F.expr("t.h = w.h and t.doc_id <=> w.doc_id")).select(
        "t.doc_id", "t.h", F.split("text", "\n").alias("lines"), "wanted").select(
        "doc_id", "h", "lines", F.explode("wanted").alias("x")).select(
        "doc_id", "h", "x.line_no", "x.node", "x.copies", F.lower(F.col("lines")[F.col("x.line_no")]).alias("raw"), F.lit(True).alias("odd"))
    lines = _normalised(raw)
    sets = _with_keys(lines, ranks).select("node", _place().alias("first"), "copies", "keys")
    return sets.dropDuplicates(["node"])  # repeated rows hold a line twice


def _links(lists: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n, earlier) of each member of a list: node, group label, linked copies, an earlier line is linked."""
    # each list's size is that of its nodes alone, so the sets are made once and go to their lists unwritten
    members = lists.join(sets, "node").withColumns({
        "n": F.size("keys"), "at": F.expr("cast(array_position(keys, key) as int)")})
    shards = bounded_shards(members, "key", "node", SLICE, lists).groupBy("key", "_i", "_k").agg(
        F.collect_list(F.struct("node", "first", "copies", "keys", "n", "at", "_slice")).alias("m")).filter("size(m) > 1")
    linked = """a.node <> b.node and (_i = _k or a._slice <> b._slice)
        and 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
        and 9 * (1 + least(a.n - a.at, b.n - b.at)) >= 4 * (a.n + b.n)
        and not arrays_overlap(slice(a.keys, 1, a.at - 1), slice(b.keys, 1, b.at - 1))
        and 9 * size(array_intersect(a.keys, b.keys)) >= 4 * (a.n + b.n)"""
    near = shards.withColumn("near", F.expr(
        f"transform(m, a -> filter(transform(m, (b, j) -> if({linked}, j, -1)), j -> j >= 0))"))
    # labels: each member in turn takes its group and its neighbours' groups into the least of them
    near = near.withColumn("label", F.expr("""aggregate(sequence(0, size(m) - 1), sequence(0, size(m) - 1), (l, i) ->
        if(size(near[i]) = 0, l, transform(array(array_distinct(array_append(transform(near[i], j -> l[j]), l[i]))),
            g -> transform(l, x -> if(array_contains(g, x), array_min(g), x)))[0]))"""))
    out = near.select(F.explode(F.expr("""filter(transform(m, (a, i) -> named_struct('a', a.node, 'b', m[label[i]].node,
        'n', aggregate(near[i], 0L, (s, j) -> s + m[j].copies), 'earlier', exists(near[i], j -> m[j].first < a.first))), x -> x.n > 0)""")).alias("x"))
    return out.select("x.*")


def line_classes(docs: DataFrame) -> DataFrame:
    """Each class of equal lines with its links.

    (k1, k2, first, copies, earlier, n_links, class_first): ``earlier`` tells
    that a linked class has an earlier line, ``class_first`` is the first line
    of all classes that links connect with this one.
    """
    ranks = _ranks(docs)
    classes = _classes(docs, ranks)
    lists = _lists(classes)
    found = materialize(_links(lists, _sets(docs, classes, lists, ranks)), "line-links")
    sums = found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("_n"), F.max("earlier").alias("_earlier"))
    groups = components(found.select("a", "b"))
    some = sums.join(groups, "node").join(classes.select("node", "first"), "node")
    heads = some.groupBy("component").agg(F.min("first").alias("class_first"))
    some = some.join(heads, "component").select("node", "_n", "_earlier", "class_first")
    out = classes.join(some, "node", "left").select(
        "k1", "k2", "first", "copies", F.coalesce("_earlier", F.lit(False)).alias("earlier"),
        (F.coalesce("_n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("class_first", "first").alias("class_first"))
    return out


def line_links(docs: DataFrame) -> DataFrame:
    """One row for each line with words: doc_id, h, line_no, n_links, class_doc_id, class_line_no, removed.

    Words are lower-cased and parted by blanks; a blank line is in no class
    and always stays, a null or empty text has no lines.  Lines are ordered by
    doc_id (null last), text and line number.  Rows repeated with the same id
    and text are alike in every result.  Other columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    classes = line_classes(docs)
    lines = _lines(docs).select("doc_id", "h", "line_no", *_names()).join(classes, ["k1", "k2"])
    return lines.select("doc_id", "h", "line_no", "n_links", F.col("class_first.doc_id").alias("class_doc_id"),
                        F.col("class_first.line_no").alias("class_line_no"),
                        (F.col("earlier") | (_place() != F.col("first"))).alias("removed"))


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with every removed line cut from ``text`` (``n_chars``, if there, set anew)."""
    gone = line_links(docs).filter("removed").groupBy("doc_id", "h").agg(F.collect_set("line_no").alias("gone"))
    text = docs.withColumn("_h", F.xxhash64("text")).alias("t")
    joined = text.join(gone.alias("g"), F.expr("t._h = g.h and t.doc_id <=> g.doc_id"), "left")
    # bound to a name, so that a text is split once and not for every line
    kept = F.expr("""if(g.gone is null, t.text, transform(array(split(t.text, '\n')), l -> concat_ws('\n',
        transform(array_except(sequence(0, size(l) - 1), g.gone), i -> l[i])))[0])""")
    out = joined.withColumn("_kept", kept)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_kept").alias(c))
        elif c == "n_chars":
            columns.append(F.length("_kept").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"t.`{c}`"))
    return out.select(*columns)


def op2_line_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, links and removal of every line of all documents."""
    return line_links(table(spark, sf_dir, "documents")).drop("h")


#: The same by all pairs of classes that share a shingle, where no doc_id repeats.
SQL = f"""
WITH RECURSIVE raw AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS line_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
worded AS (SELECT doc_id, line_no, list_filter(regexp_split_to_array(lower(line), '[ \\t\\r\\x0B\\x0C]+'), lambda w: w <> '') AS words FROM raw),
lines AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY doc_id IS NULL, doc_id, line_no) AS place FROM worded WHERE len(words) > 0),
classes AS MATERIALIZED (SELECT words, min(place) AS c, count(*) AS copies FROM lines GROUP BY words),
tokens AS MATERIALIZED (SELECT DISTINCT c, words[i:i + {SHINGLE - 1}] AS token
  FROM (SELECT c, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i FROM classes WHERE len(words) >= {SHINGLE})),
sizes AS (SELECT c, count(*) AS n FROM tokens GROUP BY c),
shared AS (SELECT a.c AS a, b.c AS b, count(*) AS n FROM tokens a JOIN tokens b ON a.token = b.token AND a.c <> b.c GROUP BY a.c, b.c),
link AS MATERIALIZED (SELECT a, b FROM shared JOIN sizes x ON x.c = a JOIN sizes y ON y.c = b WHERE 9 * shared.n >= 4 * (x.n + y.n)),
reach AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
heads AS (SELECT a, min(b) AS head FROM reach GROUP BY a),
linked AS (SELECT a, sum(y.copies) AS n, min(b) AS earliest FROM link JOIN classes y ON y.c = b GROUP BY a)
SELECT l.doc_id, CAST(l.line_no AS INTEGER) AS line_no, CAST(coalesce(k.n, 0) + x.copies - 1 AS BIGINT) AS n_links,
  f.doc_id AS class_doc_id, CAST(f.line_no AS INTEGER) AS class_line_no,
  coalesce(k.earliest < x.c, false) OR l.place <> x.c AS removed
FROM lines l JOIN classes x ON x.words = l.words LEFT JOIN heads h ON h.a = x.c LEFT JOIN linked k ON k.a = x.c
  JOIN lines f ON f.place = least(x.c, h.head)"""
