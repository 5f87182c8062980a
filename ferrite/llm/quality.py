"""Quality rules as a short-circuit cascade.

A rule rejects a text by figures of it (words, symbols, repeated lines ...).
Figures are made when a rule first asks for them and are shared by the rules
after it, so what a rule costs depends on the rules before it.  ``plan`` times
every figure and notes which rules reject which texts on a sample of the
documents; then it orders the rules greedily: next comes the rule that rejects
the most of the sample's texts still left for the time of the figures still
missing.  The cascade tests each text in that order and stops at the first
rule that rejects it.

The order decides what is computed, never the verdict: a text is kept if no
rule rejects it.  So the sample is the only part that does not look at every
row, and a task that runs again gives the same result.  There is no shuffle
but that of the sample's sums.
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, byte_class, segments, small_batches, table, utf8

#: Rows of the sample that costs and rejections are estimated on (about so many, however large the table).
SAMPLE_ROWS = 2000

BLANKS = b" \t\n\v\f\r"
_TAILS = bytes(range(0x80, 0xC0))  # bytes of a character after its first
_NO_BLANK = byte_class(lambda b: b not in BLANKS)
_UPPER = byte_class(lambda b: 65 <= b <= 90)
_LOWER = byte_class(lambda b: 97 <= b <= 122)
_LETTER = byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
SYMBOLS = b"#*$%&|<>"


class Figures:
    """Figures of one text, made on demand.  Words are parted by ASCII blanks."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def n_words(self) -> int:
        return sum(len(part.split()) for part in segments(self.data, _NO_BLANK))

    @cached_property
    def word_chars(self) -> int:
        """Code points in words."""
        return len(self.data.translate(None, _TAILS + BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip(BLANKS)]

    @cached_property
    def n_lines(self) -> int:
        """Lines with a word."""
        return len(self.lines)

    @cached_property
    def n_dup_lines(self) -> int:
        """Lines with a word that equal an earlier line."""
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_bullet_lines(self) -> int:
        return sum(line.lstrip(BLANKS).startswith((b"-", b"*", b"\xe2\x80\xa2")) for line in self.lines)

    @cached_property
    def n_cut_lines(self) -> int:
        """Lines that end in an ellipsis."""
        return sum(line.rstrip(BLANKS).endswith((b"...", b"\xe2\x80\xa6")) for line in self.lines)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in three-word windows that are found twice or more, the first included."""
        number: dict[bytes, int] = {}
        ids = np.concatenate([np.zeros(0, np.int64)] + [
            np.array([number.setdefault(w, len(number)) for w in part.split()], np.int64)
            for part in segments(self.data, _NO_BLANK)])
        if len(ids) < 4:
            return 0
        # a window's number is exact: pairs of words are numbered before the third joins
        _, pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
        _, window, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        twice = times[window] > 1
        hit = np.zeros(len(ids), bool)
        for j in range(3):
            hit[j:len(ids) - 2 + j] |= twice
        return int(hit.sum())

    @cached_property
    def letter_counts(self) -> tuple[int, int]:
        """Words without a letter; words with two capitals A-Z or more and no letter a-z."""
        bare = shouted = 0
        for part in segments(self.data, _NO_BLANK):
            buf = np.frombuffer(part, np.uint8)
            inside = _NO_BLANK[buf]
            starts = np.flatnonzero(inside & np.concatenate(([True], ~inside[:-1])))
            if len(starts):
                bare += int((np.add.reduceat(_LETTER[buf], starts, dtype=np.int32) == 0).sum())
                shouted += int(((np.add.reduceat(_UPPER[buf], starts, dtype=np.int32) > 1)
                                & (np.add.reduceat(_LOWER[buf], starts, dtype=np.int32) == 0)).sum())
        return bare, shouted


@dataclass(frozen=True)
class Rule:
    """``rejects(figures)`` may read the figures named in ``needs`` and no others."""
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Figures], bool]


#: What else a figure reads.
_READS = {"n_lines": ("lines",), "n_dup_lines": ("lines",), "n_bullet_lines": ("lines",), "n_cut_lines": ("lines",)}

#: The two rules of the base; a text of no words fails the first.
BASE_RULES = (
    Rule("few_words", ("n_words",), lambda t: t.n_words < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: Shares after published rules for web text: symbols and words without letters,
#: lengths of words, lines that repeat, are bullets or are cut, and shouting.
RULES = BASE_RULES + (
    Rule("short_or_long_words", ("n_words", "word_chars"), lambda t: not 2 * t.n_words <= t.word_chars <= 12 * t.n_words),
    Rule("symbols", ("n_words", "n_symbols"), lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda t: 2 * t.n_dup_lines > t.n_lines),
    Rule("bullets", ("n_lines", "n_bullet_lines"), lambda t: 10 * t.n_bullet_lines > 9 * t.n_lines),
    Rule("cut_lines", ("n_lines", "n_cut_lines"), lambda t: 10 * t.n_cut_lines > 3 * t.n_lines),
    Rule("words_without_letters", ("n_words", "letter_counts"), lambda t: 10 * t.letter_counts[0] > 3 * t.n_words),
    Rule("shouting", ("n_words", "letter_counts"), lambda t: 10 * t.letter_counts[1] > 5 * t.n_words),
)


@dataclass(frozen=True)
class Step:
    """A rule in its place: seconds a text of the figures it adds, share of the texts left that it rejects."""
    rule: Rule
    cost: float
    rejected: float


def _all_needs(needs: Iterable[str]) -> list[str]:
    """``needs`` and what they read, what is read first."""
    out: list[str] = []
    for n in needs:
        for x in [*_all_needs(_READS.get(n, ())), n]:
            if x not in out:
                out.append(x)
    return out


def ordered(rules: Sequence[Rule], masks: dict[int, int], cost: dict[str, float], given: Iterable[str] = ()) -> list[Step]:
    """The rules by rejections for their cost, greedily on what earlier rules leave.

    ``masks``: texts of the sample by the rules that reject them (bit i for
    rule i); ``cost``: seconds a text of each figure; ``given``: figures that
    are made for every text whatever the order.  Rules that reject nothing
    come last, the cheapest first; equals stay in the order of ``rules``.
    """
    made, left, steps, rest = set(_all_needs(given)), dict(masks), [], list(range(len(rules)))

    def price(i):
        return sum(cost[f] for f in _all_needs(rules[i].needs) if f not in made)

    def gain(i):
        return sum(n for m, n in left.items() if m >> i & 1)

    while rest:
        def worth(i):
            hit, paid = gain(i), price(i)
            return (hit > 0, hit / paid if paid else float("inf") if hit else 0.0, -paid, -i)
        i = max(rest, key=worth)
        total = sum(left.values())
        steps.append(Step(rules[i], price(i), gain(i) / total if total else 0.0))
        made.update(_all_needs(rules[i].needs))
        left = {m: n for m, n in left.items() if not m >> i & 1}
        rest.remove(i)
    return steps


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, given: Iterable[str] = (), sample_rows: int = SAMPLE_ROWS) -> list[Step]:
    """The order of the cascade, from the costs and rejections on a sample of ``docs``.

    Sums by set of rejecting rules and by figure reach the driver: as many
    rows as the sample has different sets, and one for each figure.  An empty
    sample leaves the rules in the order of their number of figures.
    """
    rules = tuple(rules)
    figures = _all_needs(f for r in rules for f in r.needs)
    n = docs.count()
    some = docs.select("text") if n <= sample_rows else docs.select("text").sample(sample_rows / n, 13)
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            sums: dict[tuple[bool, int], int] = defaultdict(int)
            for data in utf8(batch.column(0)):
                t = Figures(data or b"")
                for i, f in enumerate(figures):
                    before = time.perf_counter_ns()
                    getattr(t, f)
                    sums[False, i] += time.perf_counter_ns() - before
                sums[True, sum(1 << i for i, r in enumerate(rules) if r.rejects(t))] += 1
            yield pa.RecordBatch.from_pydict({"is_mask": [k[0] for k in sums], "key": [k[1] for k in sums], "value": list(sums.values())})

    sums = some.mapInArrow(run, "is_mask boolean, key long, value long").groupBy("is_mask", "key").agg(F.sum("value").alias("value"))
    masks, spent = {}, dict.fromkeys(figures, 0)
    for r in sums.collect():
        if r.is_mask:
            masks[r.key] = r.value
        else:
            spent[figures[r.key]] = r.value
    seen = sum(masks.values()) or 1
    return ordered(rules, masks, {f: v / seen / 1e9 for f, v in spent.items()}, given)


def with_verdict(docs: DataFrame, steps: Sequence[Step], figures: Sequence[str] = ()) -> DataFrame:
    """``docs`` with the integer ``figures`` asked for, ``failed_rule``, ``n_tested`` and ``kept``.

    ``failed_rule`` is the first rule of ``steps`` that rejects the text (null:
    none), ``n_tested`` how many were tested.  A null or empty text has no
    words and is tested like any other; so are very long ones, whose words are
    read in segments.  Repeated rows get the same verdict; columns of ``docs``
    with these names are replaced.
    """
    rules = [s.rule for s in steps]
    fields = [T.StructField(f, T.LongType()) for f in figures] + [
        T.StructField("failed_rule", T.StringType()), T.StructField("n_tested", T.LongType()), T.StructField("kept", T.BooleanType())]

    def start():
        def f(texts):
            rows = []
            for data in utf8(texts):
                t = Figures(data or b"")
                failed = next(((i, r.name) for i, r in enumerate(rules) if r.rejects(t)), None)
                rows.append((*[getattr(t, x) for x in figures], failed and failed[1],
                             failed[0] + 1 if failed else len(rules), failed is None))
            return list(zip(*rows)) if rows else [[] for _ in fields]
        return f

    return append_columns(docs, ["text"], fields, start)


def kept(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows and columns of ``docs`` that no rule rejects."""
    return with_verdict(docs, plan(docs, rules)).filter("kept").select(*docs.columns)


BASE_FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op13_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and verdict of every document; the base figures are made for all, so their rules cost nothing more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_verdict(docs, plan(docs, RULES, BASE_FIGURES), BASE_FIGURES)
    base = " or ".join(("n_words < 50", "100 * n_repeat_words > 50 * n_words"))
    return found.select("doc_id", *BASE_FIGURES, F.expr(base).alias("base_failed"), "kept")


#: DuckDB twin of op13_quality_cascade: a text is kept if no rule rejects it, in whatever order.
SQL = r"""
with t as (select doc_id, coalesce(text, '') as text, row_number() over () as k from documents),
w as (select k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from t),
g as (select k, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from (select k, ws, unnest(range(1, len(ws) - 1)) as i from w)),
r as (select k, i from g qualify count(*) over (partition by k, g) > 1),
rep as (select k, count(distinct i + j) as n from r, (select unnest([0, 1, 2]) as j) group by k),
f as (select w.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
             len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
             len(list_filter(ls, lambda l: regexp_matches(l, '^[\x20\x09-\x0D]*[-*•]'))) as n_bullet,
             len(list_filter(ls, lambda l: regexp_matches(l, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) as n_cut,
             len(list_filter(ws, lambda x: not regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as n_bare,
             len(list_filter(ws, lambda x: regexp_matches(x, '(?s)[A-Z].*[A-Z]') and not regexp_matches(x, '[a-z]'))) as n_shouted
      from w left join rep using (k))
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or word_chars < 2 * n_words or word_chars > 12 * n_words
            or 10 * n_symbols > n_words or 2 * n_dup_lines > n_lines or 10 * n_bullet > 9 * n_lines or 10 * n_cut > 3 * n_lines
            or 10 * n_bare > 3 * n_words or 10 * n_shouted > 5 * n_words) as kept
from f
"""
