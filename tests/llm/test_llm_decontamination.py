import hashlib
import re

import numpy as np
import pytest
from cases import PASSAGE, clashing, frame, rows

from ferrite.llm.decontamination import decontaminated, scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


ITEMS = [(1, PASSAGE), (2, "w1 w2 w3"), (10, "x"), (4, None), (5, ""), (6, "..."), (7, PASSAGE), (None, "short line")]


def brute(text, items):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[k:k + n]), set()).add(i)
    w = words(text)
    hit, found = set(), set()
    for n in {len(g) for g in grams}:
        for k in range(len(w) - n + 1):
            if g := grams.get(tuple(w[k:k + n])):
                found |= g
                hit |= set(range(k, k + n))
    ids = sorted(str(i) for i in found if i is not None)
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), 20 * len(hit) >= len(w) and bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_hits_equal_brute_force(spark, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = scan(clashing(spark, "N_HIT", "_marks"), items, block_bytes=block_bytes).collect()
    assert len(got) == len(rows())
    for r in got:
        ids = hashlib.sha256(",".join(r.item_ids).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, ids, r.contaminated) == brute(r.text, ITEMS)
        assert sum(len(words(r.text[x.start:x.end])) for x in r.hit_ranges) == r.n_hit


def test_removal(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    docs = frame(spark)
    kept = decontaminated(docs, items)
    assert kept.columns == docs.columns
    assert {85, 86} & {r.doc_id for r in kept.collect()} == set()
    assert kept.count() == len(rows()) - 2
    cut = {r.doc_id: r for r in decontaminated(docs, items, "spans").collect()}
    assert cut[85].text == "before  after" and cut[86].text == "" and cut[85].n_chars == 13


def test_empty_tables(spark):
    items = spark.createDataFrame([], "item_id long, text string")
    assert scan(frame(spark, []), items).count() == 0
    assert {r.n_hit for r in scan(frame(spark), items).collect()} == {0}


def test_blocks_hold_their_bytes_also_with_repeated_rows(spark):
    from ferrite.llm.decontamination import _blocks
    some = [(i, f"item {i} " + "word " * (20 + i % 7)) for i in range(40)]
    items = spark.createDataFrame(some + [some[0]] * 50 + [(None, "no id"), (None, "no id"), (7, None)], "item_id long, text string")
    blocks = list(_blocks(items, 1000))
    assert max(sum(len(t) for _, t in b) for b in blocks) <= 1000
    found = sorted((i or "", t.decode()) for b in blocks for i, t in b)
    assert found == sorted([(str(i), t) for i, t in some] + [("", "no id")])


def test_repeated_windows_are_not_compared_pairwise():
    import time

    from ferrite.llm.common import word_hashes
    from ferrite.llm.decontamination import _Windows
    data = b"a " * 20_000
    before = time.perf_counter()
    windows = _Windows([(str(i), data) for i in range(3)] + [("b", b"b " * 40 + b"c")], 13)
    hit, items = windows.hits(data, *word_hashes(data))
    assert hit.all() and len(hit) == 20_000 and items == {0, 1, 2}
    assert time.perf_counter() - before < 5


def test_windows_of_equal_hash_are_told_apart(monkeypatch):
    from ferrite.llm import decontamination as D
    monkeypatch.setattr(D, "window_hashes", lambda h, n: np.zeros(max(0, len(h) - n + 1), np.uint64))
    windows = D._Windows([("x", b"a b c"), ("y", b"a b c a"), ("z", b"b c a")], 3)
    data = b"q a b c a q"
    hit, items = windows.hits(data, *D.word_hashes(data))
    assert hit.tolist() == [False, True, True, True, True, False] and items == {0, 1, 2}
    hit, items = windows.hits(b"a b c", *D.word_hashes(b"a b c"))
    assert hit.all() and items == {0, 1}
