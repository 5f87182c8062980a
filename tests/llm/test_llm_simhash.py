import random
import re

import xxhash
from cases import clashing, frame, rows

from ferrite.llm import simhash
from ferrite.llm.simhash import BKTree, fingerprint, near_duplicates, one_of_each


def plain(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if w]
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(n)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes) > 0)


def groups(prints, bits):
    ids = list(prints)
    group = {i: i for i in ids}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in ids:
        for j in ids:
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                group[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_fingerprints():
    for _, t, *_ in rows():
        assert fingerprint((t or "").encode()) == plain(t)


def test_tree_finds_all_within():
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(300)]
    values += [v ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for v in values]
    tree = BKTree()
    for v in values:
        tree.add(v)
    for x in values[:100]:
        assert sorted(tree.within(x, 3)) == [i for i, v in enumerate(values) if (v ^ x).bit_count() <= 3]


def test_groups_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SLICE", 4)  # hot shards are cut
    rng = random.Random(9)
    some = [r for r in rows() if r[0] is not None and r[0] != 91]
    prints = {d: plain(t) for d, t, *_ in some}
    got = {r.doc_id: r for r in near_duplicates(frame(spark, some)).collect()}
    want = groups(prints, 3)
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{prints[d]:016x}", want[d]) for d in prints}
    # dense groups and chains of fingerprints as such
    values = {i: rng.getrandbits(64) for i in range(200)}
    for i in range(200, 500):
        values[i] = values[rng.randrange(0, i)] ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)
    df = spark.createDataFrame([(i, v - (1 << 64) if v >> 63 else v) for i, v in values.items()], "doc_id long, simhash long")
    ids = {r.simhash & (1 << 64) - 1: r.component_id for r in simhash.groups(df).collect()}
    assert {i: ids[v] for i, v in values.items()} == groups(values, 3)


def test_one_of_each(spark):
    docs = clashing(spark, "simhash", "_id", "row", "component_id")
    got = one_of_each(docs)
    out = got.collect()
    assert got.columns == docs.columns and {r.simhash for r in out} == {"clash"}
    ids = [r.doc_id for r in out]
    assert ids.count(91) == 2  # two texts of one id, one of them in two rows
    assert all(ids.count(i) == 1 for i in ids if i not in (None, 91))
    single = {d: plain(t) for d, t, *_ in rows() if d is not None and d != 91}
    assert {d for d in ids if d in single} == {d for d, first in groups(single, 3).items() if d == first}
    assert 80 in ids and not {76, 77, 78, 79, 81, 82} & set(ids)
    everything = near_duplicates(frame(spark)).collect()
    assert len(everything) == len(rows())
    assert near_duplicates(frame(spark, [])).count() == 0 and one_of_each(frame(spark, [])).count() == 0
