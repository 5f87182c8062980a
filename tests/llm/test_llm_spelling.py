import random
import re
import zlib
from collections import Counter

import pytest
from cases import clashing, frame, rows

from ferrite.llm import spelling as S


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(some, least=3):
    n = Counter()
    for d, t, *_ in some:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def brute_groups(n):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(df):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}
    assert len(out) == df.count()
    return out


def vocabulary(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long")


def test_pivots_are_disjoint_and_least():
    rng = random.Random(2)
    for _ in range(300):
        places = sorted(rng.sample(range(12), rng.randrange(3, 8)))
        weights = [rng.randrange(1, 9) for _ in places]
        got = S.pivots(places, weights)
        weight = dict(zip(places, weights))
        assert len(got) == 2 and got[1] - got[0] >= 2
        assert sum(weight[p] for p in got) == min(weight[a] + weight[b] for a in places for b in places if b - a >= 2)
    with pytest.raises(ValueError):
        S.pivots([3, 4], [1, 1])


def test_groups_equal_brute_force(spark):
    rng = random.Random(5)
    # few letters: words that hold one bigram many times, and many near words
    n = {}
    for _ in range(500):
        n["".join(rng.choice("abé") for _ in range(rng.randrange(5, 9)))] = rng.randrange(3, 400)
    for _ in range(200):
        w = "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(5, 14)))
        at = rng.randrange(len(w))
        n[w], n[w[:at] + w[at + 1:] + "x"], n[w[:at] + "z" + w[at:]] = rng.randrange(50, 400), rng.randrange(3, 40), 3
    n = {w: c for w, c in n.items() if len(w) >= 5}
    n["q" * 40], n["q" * 41], n["y" * 5000], n["y" * 4999] = 3, 9, 3, 6
    want = brute_groups(n)
    assert found(S.spelling_groups(vocabulary(spark, n))) == want
    assert S.near_pairs(vocabulary(spark, n), 3).count() == sum(x[3] for x in want.values()) // 2  # long lists are cut


def test_ties_and_chains(spark):
    n = {"aaaaa": 3, "aaaab": 6, "aaaac": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "zzzzz": 3}
    got = found(S.spelling_groups(vocabulary(spark, n)))
    assert got == brute_groups(n)
    assert got["aaaaa"][0] == "aaaab" and got["aaaaa"][1] == "abbbb" and got["zzzzz"] == (None, "zzzzz", 3, 0, None)
    chain = spark.createDataFrame([(f"{i:05}", f"{i + 1:05}") for i in range(37)], "word string, form string")
    assert {r.root for r in S.roots(chain).collect()} == {"00037"}


def test_words_of_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(S, "SUMMED_WORDS", 10)
    some = rows() + [(200, " ".join(["Straße École straßen"] * 4) + " " + "longtext " * 200_000, "de", "s")]
    some += [(i, "spelling mistake spelling", "en", "hot") + (None,) for i in range(300, 700)]
    some = [(*r[:4], None) for r in some]
    want = brute_words(some)
    got = S.vocabulary(frame(spark, some), change=S.misspelt)
    assert {r.word: r.n for r in got.collect()} == want and "École" in want and len(want) > 5
    assert found(S.spelling_groups(got)) == brute_groups(want)
    empty = S.vocabulary(frame(spark, []), change=S.misspelt)
    assert empty.count() == 0 and S.spelling_groups(empty).count() == 0
    names = clashing(spark, "word", "n", "form", "root")
    assert {r.word: r.n for r in S.vocabulary(names, change=S.misspelt, least_count=1).collect()} == brute_words(rows(), 1)
    with pytest.raises(ValueError):
        S.vocabulary(names, least_chars=3)
