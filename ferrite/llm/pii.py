"""Personal data, also behind disguises, with offsets into the source text.

Base identifiers are found on the text as it is.  For texts that show signs
of disguise, transducers rewrite look-alike characters, "at" and "dot" in
words or brackets, and spelled digits; each keeps, for every character it
writes, the source range it came from.  The same detectors run on the
rewritten text, and what they find is mapped back to source characters.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrite.llm.common import append_columns, table

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits, so the look-behind only saves time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str):
    at, free = text.find("@"), 0  # free: end of the last match
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) < 256


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base identifiers, by start, then kind as listed."""
    found = []
    if "@" in text:
        found += [("email", s, e) for s, e in _emails(text)]
    if "." in text:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


# ---- transducers -----------------------------------------------------------

# Letters of other scripts that look like Latin ones.
_LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝкмтвнАЕОРСУХІЈЅКМТВНαοικνρτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "aeopcyxijshdqwkmtbhAEOPCYXIJSKMTBHaoiknptuxABEZHIKMNOPTYX"))
# The digits 0 to 9 in words.
_DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
# Fixed values: "at" and "dot" in words, and last labels trusted behind plain words, also those longer than four letters.
_AT_NAMES = "at|ät|arroba|arobase"
_DOT_WORDS = "dot|point|punkt|punto"
_LAST_LABELS = frozenset("""com org net edu gov mil int info biz io co ai app dev de fr es uk eu us ca ch at it nl be pl ru in cn jp br example test
academy agency center cloud codes company design digital email energy events expert finance global group health house media
museum network online photo schule shopping social solutions space store studio systems today tools travel video website
world""".split())
#: Labels that are English words: nothing is meant by "at this point in".
_WORD_LABELS = frozenset("in it be at us".split())

_INVISIBLE = "­​‌‍‎‏⁠﻿"
_WIDE = re.compile("[­Ͱ-ԯ٠-٩۰-۹०-९​-‏‐-―⁠⁰-ₙ−①-⓿﻿！-～\U0001d400-\U0001d7ff]")
_OPEN, _SHUT = r"[\[({<]", r"[\])}>]"
_AT_MARK = re.compile(rf"\s?{_OPEN}\s?(?:{_AT_NAMES}|@)\s?{_SHUT}\s?", re.I)
_DOT_MARK = re.compile(rf"\s?{_OPEN}\s?(?:{_DOT_WORDS}|\.)\s?{_SHUT}\s?", re.I)
_LABEL = r"[A-Za-z0-9-]+"
_AT_WORDS = re.compile(
    rf"(?<=[A-Za-z0-9._%+-])(\s+({_AT_NAMES})\s+|@){_LABEL}(?:(?:\s+(?:{_DOT_WORDS})\s+|\.){_LABEL})+(?![A-Za-z0-9])", re.I)
_DOT_WORD = re.compile(rf"\s+({_DOT_WORDS})\s+", re.I)
_SHORT_LABEL = re.compile("[a-z]{2,4}")
_BRACKETED = re.compile(rf"{_OPEN}\s?(?:{_AT_NAMES}|@|{_DOT_WORDS}|\.)\s?{_SHUT}", re.I)


def _spelled(words: str) -> tuple[re.Pattern, re.Pattern, dict[str, str]]:
    values = {w: str(i) for i, w in enumerate(words.split())}
    one = "(?:" + "|".join(values) + ")"
    between = rf"(?:[\x20-]|\s(?:{_DOT_WORDS})\s)"
    any_one = f"(?:{one}|[0-9]++)"
    run = re.compile(rf"(?<!\w)(?:plus\x20)?{any_one}(?:{between}{any_one})+(?!\w)", re.I)
    token = re.compile(rf"(plus)\x20|\s({_DOT_WORDS})\s|({one})|([0-9]++)|[\x20-]", re.I)
    return run, token, values


_SPELLED = [_spelled(w) for w in _DIGIT_WORDS]


class _Tape:
    """A text and, for each of its characters, the source range it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ranges (in order, apart) by strings; each new character stands for the whole range."""
        if not edits:
            return
        said, starts, ends, at = [], [], [], 0
        for s, e, new in edits:
            said += [self.text[at:s], new]
            starts += [self.starts[at:s], np.full(len(new), self.starts[s])]
            ends += [self.ends[at:s], np.full(len(new), self.ends[e - 1])]
            at = e
        self.text = "".join([*said, self.text[at:]])
        self.starts = np.concatenate([*starts, self.starts[at:]])
        self.ends = np.concatenate([*ends, self.ends[at:]])


def _plain(c: str) -> str:
    """The ASCII character that ``c`` looks like; nothing for an invisible one; else c."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    if "‐" <= c <= "―" or c == "−":
        return "-"
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(d)
    same = unicodedata.normalize("NFKC", c)
    return same if len(same) == 1 and same.isascii() else _LOOKALIKES.get(same, c)


def _word_edits(tape: _Tape) -> list[tuple[int, int, str]]:
    """Edits for "name at host dot com" in plain words, where a mark that was rewritten counts like a word.

    The last label must be a known one, or have two to four letters if both
    "at" and "dot" are said.
    """
    text, edits = tape.text, []

    def rewritten(i: int) -> bool:
        return tape.ends[i] - tape.starts[i] > 1

    for m in _AT_WORDS.finditer(text):
        dots = list(_DOT_WORD.finditer(text, m.end(1), m.end()))
        if not dots and not any(text[i] == "." and rewritten(i) for i in range(m.end(1), m.end())):
            continue
        last = re.split(rf"\s+(?:{_DOT_WORDS})\s+|\.", m[0], flags=re.I)[-1].lower()
        said = m[2] or rewritten(m.start(1))
        if last not in _LAST_LABELS and not (said and _SHORT_LABEL.fullmatch(last)):
            continue
        if (m[2] or "").lower() == "at" and any(d[1].lower() == "point" for d in dots) and (
                last in _WORD_LABELS or last not in _LAST_LABELS):
            continue
        edits += [*([(*m.span(1), "@")] if m[2] else []), *((*d.span(), ".") for d in dots)]
    return edits


def _digit_edits(text: str, run: re.Pattern, token: re.Pattern, values: dict[str, str]) -> list[tuple[int, int, str]]:
    """Edits for four digits and more, all spelled, or two and more of them spelled among figures."""
    edits = []
    for m in run.finditer(text):
        tokens = list(token.finditer(text, m.start(), m.end()))
        spelled, figures = sum(bool(t[3]) for t in tokens), sum(len(t[4] or "") for t in tokens)
        if spelled + figures < 4 or spelled < 2:
            continue
        for i, t in enumerate(tokens):
            if t[4] or (not any(t.groups()) and not any(x[3] for x in tokens[max(0, i - 1):i + 2])):
                continue  # figures, and what stands between figures
            new = "+" if t[1] else "." if t[2] else values[t[3].lower()] if t[3] else ""
            edits.append((*t.span(), new))
    return edits


def _undisguised(text: str) -> _Tape | None:
    """The rewritten text, or None where nothing had to be rewritten."""
    tape = _Tape(text)
    if not text.isascii() and _WIDE.search(text):
        tape.rewrite([(m.start(), m.end(), p) for m in _WIDE.finditer(text) if (p := _plain(m[0])) != m[0]])
    lowered = tape.text.lower()
    if any(o in lowered for o in "[({<") and _BRACKETED.search(tape.text):
        tape.rewrite([(*m.span(), "@") for m in _AT_MARK.finditer(tape.text)])
        tape.rewrite([(*m.span(), ".") for m in _DOT_MARK.finditer(tape.text)])
    if tape.text != text or any(w in lowered for w in _DOT_WORDS.split("|")):
        tape.rewrite(_word_edits(tape))
    for run, token, values in _SPELLED:
        if sum(w in lowered for w in values) > 0:
            tape.rewrite(_digit_edits(tape.text, run, token, values))
    return tape if tape.text != text else None


def spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) by start, then kind; code points, end exclusive.

    Every base identifier stays; a disguised one is added unless a base one of
    its kind covers it.
    """
    base = detect(text)
    found = [(*x, True) for x in base]
    tape = _undisguised(text)
    if tape is not None:
        for kind, s, e in detect(tape.text):
            start, end = int(tape.starts[s]), int(tape.ends[e - 1])
            if not any(k == kind and a <= start and end <= b for k, a, b in base):
                found.append((kind, start, end, False))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))


def with_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``: the spans of the whole text (null text: none).

    A column of ``docs`` named pii is replaced; repeated rows give repeated
    results; an empty table gives an empty one.
    """
    def start():
        def f(texts):
            return [[[{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in spans(t or "")] for t in texts.to_pylist()]]
        return f

    return append_columns(docs, ["text"], [T.StructField("pii", _SPANS)], start)


def redacted(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with each identifier in the text replaced by its kind in brackets.

    Overlapping spans become one, named by the kind of the first.
    """
    def start():
        def f(texts):
            out = []
            for t in texts.to_pylist():
                parts, at = [], 0
                for kind, s, e, _ in spans(t or ""):
                    if s >= at:
                        parts += [t[at:s], f"[{kind.upper()}]"]
                    at = max(at, e)
                out.append(t if t is None else "".join(parts) + t[at:])
            return [out]
        return f

    return append_columns(docs, ["text"], [T.StructField("text", T.StringType())], start).select(*docs.columns)


def op7_pii_deobfuscated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents; the four counts are of base spans, n_added of the others."""
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["base"])

    def listed(some):
        return F.concat_ws(",", F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("pii")).alias("spans"), (F.size("pii") - F.size(base)).cast("long").alias("n_added"))
