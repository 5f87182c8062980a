import hashlib
import zlib

from cases import DOCS, clashing, frame, rows
from pyspark.sql import functions as F

from ferrite.llm.merkle import folded, manifest, tampered


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(d, t, l, s, n):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d, s, l, n, t)))


def tree(nodes):
    """The top and each node's siblings (bottom up), by climbing runs of two."""
    below, siblings = [(x, [i]) for i, x in enumerate(nodes)], [[] for _ in nodes]
    while len(below) > 1:
        above = []
        for i in range(0, len(below), 2):
            run = below[i:i + 2]
            for a, (_, under) in enumerate(run):
                for k in under:
                    siblings[k] += [x for b, (x, _) in enumerate(run) if b != a]
            above.append((h(*[x for x, _ in run]), [k for _, under in run for k in under]))
        below = above
    return below[0][0], siblings


def brute(some):
    """(doc_id, leaf, claim, subroot, root, proof digest, verified) of each row."""
    by_lang = {}
    for r in some:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    subs, out = [], []
    for l in langs:
        group = sorted(by_lang[l], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
        top, siblings = tree([leaf_of(*r) for r in group])
        subs.append((group, top, siblings))
    root, upper = tree([top for _, top, _ in subs])
    for (group, top, siblings), more in zip(subs, upper):
        for r, path in zip(group, siblings):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            claim = leaf_of(*r[:4], r[4] + 1) if hit else leaf_of(*r)
            out.append((r[0], leaf_of(*r), claim, top, root, h(*path, *more), not hit))
    return sorted(out, key=str)


def listed(df):
    return sorted(((r.doc_id, r.leaf, r.claim, r.subroot, r.root, r.proof_sha256, r.verified) for r in df.collect()), key=str)


def test_equals_brute_force(spark):
    some = rows() + [(1 << 60, "x" * 300_000, "hot", "s", None)] + [((1 << 60) + i, "same", "hot", "s", 4) for i in range(1, 90)]
    some += [(7, "one row many times", "hot", "s", 18)] * 40
    want = brute(some)
    for levels in (1, 3, 12):  # superblocks of 2, 8 and 4,096 nodes
        assert listed(manifest(tampered(frame(spark, some)), levels=levels)) == want


def test_paths_fold_to_the_root(spark):
    for r in manifest(tampered(frame(spark)), levels=2).collect():
        assert folded(r.leaf, r.path) == r.root and folded(r.claim, r.path) == r.folded_root
        assert r.verified == (r.folded_root == r.root)
        assert h(*[s[1:] for s in r.path]) == r.proof_sha256


def test_small_and_odd_tables(spark):
    assert manifest(tampered(frame(spark, []))).count() == 0
    one = [(5, None, None, None, None)]
    got = manifest(tampered(frame(spark, one))).collect()[0]
    assert got.leaf == got.subroot == got.root == got.folded_root == leaf_of(*one[0]) and got.path == [] and got.proof_sha256 == h()
    assert listed(manifest(tampered(clashing(spark, "_id", "leaf", "tree", "_tree", "claim", "_pos")))) == brute(rows())
    strings = spark.createDataFrame([("a", "t", "leaf1", "leaf1"), (None, None, "leaf2", "other")], "name string, tree string, leaf string, claim string")
    got = {r.name: r for r in manifest(strings, "name").collect()}
    assert got["a"].root == h("leaf2", "leaf1") and got["a"].verified and not got[None].verified


def test_row_order_does_not_count(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    assert listed(manifest(tampered(docs.orderBy(F.xxhash64("text")).repartition(7)))) == listed(manifest(tampered(docs.coalesce(1))))
