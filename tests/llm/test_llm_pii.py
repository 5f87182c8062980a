import random
import re

import pytest
from cases import clashing, frame, rows

from ferrite.llm.pii import KINDS, detect, redacted, spans, with_spans

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    found = []
    for n, kind in enumerate(KINDS):
        for m in re.finditer(BASE[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), n, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(found)]


def test_base_equals_the_patterns():
    rng = random.Random(1)
    for _ in range(20000):
        text = "".join(rng.choices("0123456789 .-+@ab()%_\u00e94111", k=60))
        assert detect(text) == brute(text)


@pytest.mark.parametrize("text, kind, found", [
    ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("write to john.doe at example dot com today", "email", "john.doe at example dot com"),
    ("jo\u04bbn j\u043ehn@ex\u0430mple.com", "email", "j\u043ehn@ex\u0430mple.com"),
    ("call \uff0b\uff11\uff15\uff15\uff15\uff11\uff12\uff13\uff14\uff15\uff16\uff17", "phone", "\uff0b\uff11\uff15\uff15\uff15\uff11\uff12\uff13\uff14\uff15\uff16\uff17"),
    ("plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("card four" + " one" * 15 + " ok", "card", "four" + " one" * 15),
    ("at one nine two dot one six eight dot one dot one.", "ip", "one nine two dot one six eight dot one dot one"),
])
def test_disguises(text, kind, found):
    assert [(k, text[s:e]) for k, s, e, base in spans(text) if not base] == [(kind, found)]


@pytest.mark.parametrize("text, kind, found", [
    ("write john at example [dot] com now", "email", "john at example [dot] com"),
    ("write john at example (.) com now", "email", "john at example (.) com"),
    ("a juan arroba ejemplo punto com hoy", "email", "juan arroba ejemplo punto com"),
    ("an hans at beispiel punkt de heute", "email", "hans at beispiel punkt de"),
    ("a jean arobase exemple point fr", "email", "jean arobase exemple point fr"),
    ("write john at example dot xyz", "email", "john at example dot xyz"),
    ("write john [at] example dot xyz", "email", "john [at] example dot xyz"),
    ("write john at example dot online", "email", "john at example dot online"),
    ("call +1 555 one two 3 4567 now", "phone", "+1 555 one two 3 4567"),
    ("call plus one 555 two three 4 5 six seven", "phone", "plus one 555 two three 4 5 six seven"),
    ("call +155512345 six seven", "phone", "+155512345 six seven"),
    ("ip 192 dot one six 8 dot 1 dot one", "ip", "192 dot one six 8 dot 1 dot one"),
])
def test_disguises_in_other_words_and_mixed_forms(text, kind, found):
    assert [(k, text[s:e]) for k, s, e, base in spans(text) if not base] == [(kind, found)]


@pytest.mark.parametrize("text", ["we look at this point in time", "stop at that point it said", "look at example.com", "add 5 and one 7 2 3"])
def test_clean_texts_in_other_words(text):
    assert spans(text) == []


@pytest.mark.parametrize("text", ["look at this dot matrix", "meet me at home", "one two three", "we sat at example dot matrix", "\u00e9t\u00e9 \u043f\u0440\u0438\u0432\u0435\u0442", ""])
def test_clean_texts(text):
    assert spans(text) == []


def test_documents(spark):
    docs = clashing(spark, "PII")
    assert {r.doc_id for r in with_spans(docs).collect() if r.pii} == set()
    some = [(1, "a@b.c and 1.2.3.4", None, None, 0), (2, None, None, None, 0), (3, "x at y dot com", None, None, 0)]
    got = redacted(frame(spark, some))
    assert {r.doc_id: r.text for r in got.collect()} == {1: "[EMAIL] and [IP]", 2: None, 3: "[EMAIL]"}
    assert with_spans(frame(spark, [])).count() == 0 and len(rows()) == with_spans(frame(spark)).count()
