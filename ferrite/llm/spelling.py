"""Spelling variant grouping by pivotal grams.

The vocabulary of a corpus, its words one edit apart, and for each word the
much commoner near word that it is a form of.

Pivotal grams.  The bigrams of a word are ordered by how rare they are in the
vocabulary; its prefix are its three rarest (with every place of a bigram as
rare as the last), and its pivots are two disjoint bigrams of the prefix,
chosen by dynamic programming for the least sum of counts.  One edit touches
one of two disjoint bigrams at most, so a pivot of either word stands in the
other unharmed; and a pivot of the word whose prefix ends earlier in the order
lies in the prefix of the other.  So the pivots of each word are looked up in
an index of the prefixes of all words.

Position limits.  Left of an unharmed bigram or right of it nothing was
edited: the words agree up to its end, at the same place from the start, or
from its start on, at the same place from the end.  The index is keyed by
either part.  Where that part is short, the rest of both words begins or ends
alike, since it holds one edit, and its first or last characters join the key.
Lengths differ by one at most, odd character counts by two, and what is found
is verified by edit distance within the join, so that no unverified pair
leaves it.  Long lists of the index are cut into slices, and their pivots go
to each slice.

Forms are followed to the last by pointer doubling; each step at least doubles
the count, so rounds are few.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrite.llm.common import WORD_BYTES, segments, small_batches, table, utf8
from ferrite.session import materialize

#: Code points and occurrences that a word has at least.
LEAST_CHARS = 5
LEAST_COUNT = 3
#: A form is this many times as frequent as its word.
FORM_RATIO = 2
GRAM = 2
#: One edit: three grams in a prefix, two pivots.
EDITS = 1
#: An unedited part of so many characters or fewer is short; so many of the rest's first or last join its key.
SHORT_PART = 4
RIM = 2
#: Index entries in a slice of a long list.
SLICE = 4096
#: Words that a task sums up before it hands them on.
SUMMED_WORDS = 200_000

# 26 letters and the 64 characters from U+00C0 to U+00FF: 8,100 bigrams at most.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def runs(data: bytes) -> Counter[str]:
    """The runs of letters of a text in lower case (A-Z only), counted."""
    found: Counter[str] = Counter()
    for part in segments(data.translate(_TO_LOWER), WORD_BYTES):
        found.update(_RUN.findall(part.decode()))
    return found


def misspelt(doc_id, run: str) -> str:
    """One run in 97, by the CRC-32 of id and run, without one code point; a null id changes nothing."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % 97 else run[:h % len(run)] + run[h % len(run) + 1:]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", change: Callable[[object, str], str] = lambda _, run: run,
               least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of ``docs``: runs of letters after ``change(id, run)``, often and long enough.

    A null or empty text has no runs; very long ones are read in segments.
    Repeated rows count each time.  A task sums its words up before the
    shuffle, in tables of bounded size.  ``least_chars`` is 4 or more, for
    ``near_pairs``.
    """
    if least_chars < 4:
        raise ValueError("least_chars: 4 or more")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[str] = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                for r, times in runs(data or b"").items():
                    word = change(doc_id, r)
                    if len(word) >= least_chars:
                        sums[word] += times
                if len(sums) >= SUMMED_WORDS:
                    yield out()
                    sums.clear()
        yield out()

    words = docs.select(F.col(f"`{id_col}`"), "text").mapInArrow(run, "word string, n long")
    return materialize(words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count), "spelling-words")


def prefix(word: str, rank: dict[str, int]) -> tuple[list[int], int]:
    """Places of the prefix grams of ``word``, rising, and the rank that its prefix ends with."""
    ranks = [rank[word[i:i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(ranks)[min(GRAM * EDITS, len(ranks) - 1)]
    return [i for i, r in enumerate(ranks) if r <= last], last


def pivots(places: Sequence[int], weights: Sequence[int], k: int = EDITS + 1) -> list[int]:
    """``k`` disjoint grams of least weight in all, by dynamic programming over ``places`` (rising).

    Of equal sums the one that ends first is taken.  Raises ValueError if no
    ``k`` of them are disjoint.
    """
    # best[j]: least weight of j disjoint grams among those seen, and their places
    best: list[list[tuple[float, list[int]]]] = [[(0, [])] + [(float("inf"), [])] * k]
    for i, (p, w) in enumerate(zip(places, weights)):
        before = best[next((j + 1 for j in range(i - 1, -1, -1) if places[j] <= p - GRAM), 0)]
        now = list(best[-1])
        for j in range(1, k + 1):
            if before[j - 1][0] + w < now[j][0]:
                now[j] = (before[j - 1][0] + w, [*before[j - 1][1], p])
        best.append(now)
    if best[-1][k][0] == float("inf"):
        raise ValueError("too few disjoint grams")
    return best[-1][k][1]


def keys(word: str, place: int) -> Iterator[int]:
    """The index keys of the bigram at ``place``: 64-bit hashes of what is alike where it is unharmed.

    Words one edit apart share a key: a rest of 2 * RIM characters or more on
    both sides agrees in its first or last RIM (one edit lies in one half); a
    shorter one on either side meets in the key without them.
    """
    for side, part, rest in (("<", word[:place + GRAM], word[place + GRAM:]), (">", word[place:], word[:place])):
        if len(part) > SHORT_PART or len(rest) <= 2 * RIM:
            yield _hash(side + part)
        if len(part) <= SHORT_PART and len(rest) >= 2 * RIM:
            yield _hash(f"{side}{part}^{rest[:RIM]}")
            yield _hash(f"{side}{part}${rest[-RIM:]}")


def _hash(key: str) -> int:
    h = xxhash.xxh64_intdigest(key.encode())
    return h - (1 << 64) if h >> 63 else h


def _grams(words: DataFrame) -> dict[str, int]:
    """How many places each bigram has in the vocabulary; the alphabet allows 8,100 bigrams."""
    every = words.select(F.explode(F.expr(f"transform(sequence(1, length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))")).alias("gram"))
    return {r.gram: r.n for r in every.groupBy("gram").agg(F.count("*").alias("n")).collect()}


def _entries(words: DataFrame, count: dict[str, int]) -> DataFrame:
    """(pivot, key, last, word, n, len, odd): the pivots and the prefix grams of each word, by either part.

    ``odd`` has a bit for each (folded) character that the word holds an odd
    number of times: one edit changes one bit for each character it adds or takes.
    """
    rank = {g: i for i, g in enumerate(sorted(count, key=lambda g: (count[g], g)))}
    types = {"pivot": pa.bool_(), "key": pa.int64(), "last": pa.int32(), "word": pa.string(), "n": pa.int64(), "len": pa.int32(), "odd": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = defaultdict(list)
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places, last = prefix(word, rank)
                chosen = pivots(places, [count[word[p:p + GRAM]] for p in places])
                odd = 0
                for c in word:
                    odd ^= 1 << (ord(c) & 63)
                odd -= odd >> 63 << 64
                for is_pivot, some in ((True, chosen), (False, places)):
                    for key in {k for p in some for k in keys(word, p)}:
                        for name, v in zip(types, (is_pivot, key, last, word, n, len(word), odd)):
                            out[name].append(v)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out[c], t) for c, t in types.items()], names=list(types))

    return materialize(words.mapInArrow(run, "pivot boolean, key long, last int, word string, n long, len int, odd long"), "spelling-grams")


def near_pairs(words: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """(a, a_n, b, b_n) of the distinct words (word, n) exactly one edit apart, a < b, each pair once.

    Words have four code points or more (fewer have no two disjoint bigrams
    among three).
    """
    entries = _entries(words, _grams(words))
    index, probes = entries.filter("not pivot"), entries.filter("pivot")
    long_lists = index.groupBy("key").agg(F.ceil(F.count("*") / slice_size).cast("int").alias("g")).filter("g > 1")
    index = index.join(long_lists, "key", "left").withColumn("slice", F.expr("coalesce(pmod(xxhash64(word), g), 0)")).drop("g")
    probes = probes.join(long_lists, "key", "left").withColumn("slice", F.explode(F.expr("sequence(0, coalesce(g, 1) - 1)"))).drop("g")
    near = probes.alias("p").join(index.alias("i"), F.expr("""p.key = i.key and p.slice = i.slice and p.word <> i.word
        and abs(p.len - i.len) <= 1 and bit_count(p.odd ^ i.odd) <= 2 - abs(p.len - i.len) and p.last <= i.last
        and levenshtein(p.word, i.word, 1) >= 0"""))
    first = F.col("p.word") < F.col("i.word")
    pairs = near.select(*[F.when(first, F.col(f"{x}.{c}")).otherwise(F.col(f"{y}.{c}")).alias(name) for x, y, c, name in (
        ("p", "i", "word", "a"), ("p", "i", "n", "a_n"), ("i", "p", "word", "b"), ("i", "p", "n", "b_n"))])
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words of ``forms`` (word, form): the last form that is reached.

    Each round looks up the form of the form, so reach doubles.  Forms must
    not run in a circle.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.alias("a").join(now.alias("b"), F.expr("a.root = b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved"))
        now = materialize(step, "spelling-roots")
        if now.filter("moved").isEmpty():
            return now.drop("moved")


def spelling_groups(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the distinct words (word, n).

    ``form``: the near word of largest n (of equals the first in code point
    order) if its n is at least ``ratio`` times the word's, which must exceed
    1; else null, as is ``form_n``.  ``root``: the last form, the word itself
    if it has none.  No words give no rows.
    """
    both = near_pairs(words).select(F.expr("""inline(array(struct(a as word, b as other, b_n as other_n),
        struct(b as word, a as other, a_n as other_n)))"""))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), "other")).alias("best"))
    found = words.select("word", "n").join(best, "word", "left")
    is_form = F.expr(f"-best.m >= {ratio} * n")
    found = materialize(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "spelling-forms")
    last = roots(found.filter("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some of their runs misspelt, with form and root."""
    docs = table(spark, sf_dir, "documents")
    return spelling_groups(vocabulary(docs, change=misspelt))


#: DuckDB twin of op12_pivotal_grams: near words through their deletions.
SQL = r"""
with recursive found as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run
  from documents),
runs as (select doc_id, run, count(*) as c from found group by all),
bytes as (select *, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda ch:
    case when unicode(ch) < 128 then [unicode(ch)::bigint] else [192 + unicode(ch)::bigint // 64, 128 + unicode(ch)::bigint % 64] end)) as bs from runs),
hashed as (select run, c, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, bs),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
      lambda x, y: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end))) as h from bytes),
changed as (select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, c from hashed),
words as (select word, sum(c)::bigint as n from changed where length(word) >= 5 group by word having sum(c) >= 3),
dels as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as d from words, lateral (select unnest(range(0, length(word))) as i)),
near as (
  select a.word, a.n, b.word as other, b.n as other_n from dels a join dels b on a.i = b.i and a.d = b.d and a.word <> b.word
  union
  select a.word, a.n, b.word, b.n from dels a join words b on a.d = b.word
  union
  select b.word, b.n, a.word, a.n from dels a join words b on a.d = b.word),
best as (select word, count(*) as n_near, max(other_n) as m, arg_min(other, struct_pack(m := -other_n, o := encode(other))) as o from near group by word),
forms as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 2 * n then o end as form, case when m >= 2 * n then m end as form_n
  from words w left join best using (word)),
walk as (
  select word, word as here, form as nxt from forms
  union all
  select w.word, f.word, f.form from walk w join forms f on f.word = w.nxt),
ends as (select word, here as root from walk where nxt is null)
select word, form, root, n, n_near::bigint as n_near, form_n::bigint as form_n from forms join ends using (word)
"""
