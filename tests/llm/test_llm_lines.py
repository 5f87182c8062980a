from collections import Counter, defaultdict

from cases import clashing, frame, rows

from ferrite.llm import lines
from ferrite.llm.lines import line_links, without_repeated_lines


def brute(some):
    """{(doc_id, text, line): (links, first line of the class, removed)} by comparing all pairs."""
    distinct = {(d, t): n for (d, t), n in Counter((d, t) for d, t, *_ in some if t is not None).items()}
    lines = []
    for (d, t), n in distinct.items():
        for k, line in enumerate(t.split("\n")):
            w = line.lower().split()
            if w:
                lines.append(((d is None, d or 0, t, k), frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))), n))
    by_set = defaultdict(list)
    for place, s, n in lines:
        by_set[s].append((place, n))
    sets = list(by_set)
    linked = {s: [x for x in sets if x is not s and 9 * len(x & s) >= 4 * (len(x) + len(s))] for s in sets}
    return by_set, linked


def test_links_and_removal(spark):
    some = [r for r in rows() if r[0] != 91]  # ids are unique here, so the text never decides the order
    by_set, linked = brute(some)
    got = {}
    for r in line_links(frame(spark, some)).collect():
        got[r.doc_id, r.line_no] = r
    seen = 0
    for s, members in by_set.items():
        first = min(p for p, _ in members)
        links = sum(n for _, n in members) - 1 + sum(n for x in linked[s] for _, n in by_set[x])
        earlier = any(min(p for p, _ in by_set[x]) < first for x in linked[s])
        for (none, d, _, k), n in members:
            r = got[None if none else d, k]
            seen += 1
            assert r.n_links == links
            assert r.removed == (earlier or (none, d, k) != (first[0], first[1], first[3]))
    assert seen == len(got)
    assert any(linked.values())


def test_class_is_the_least_line_reachable(spark):
    some = [r for r in rows() if r[0] is not None and r[0] != 91]
    by_set, linked = brute(some)
    group = {s: s for s in by_set}

    def root(s):
        while group[s] is not s:
            s = group[s]
        return s
    for s in by_set:
        for x in linked[s]:
            a, b = root(s), root(x)
            if a is not b:
                group[a] = b
    least = {}
    for s, members in by_set.items():
        r = root(s)
        least[r] = min([least[r]] if r in least else [], default=None) or min(p for p, _ in members)
        least[r] = min(least[r], min(p for p, _ in members))
    got = {(r.doc_id, r.line_no): (r.class_doc_id, r.class_line_no) for r in line_links(frame(spark, some)).collect()}
    for s, members in by_set.items():
        for (_, d, _, k), _ in members:
            assert got[d, k] == (least[root(s)][1], least[root(s)][3])


def test_texts_without_removed_lines(spark):
    got = without_repeated_lines(clashing(spark, "gone", "_h", "lines"))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "gone", "_h", "lines"]
    out = got.collect()
    assert len(out) == len(rows())
    by_id = {r.doc_id: r for r in out if r.doc_id is not None}
    assert by_id[80].text is None and by_id[81].text == "" and by_id[82].text == " \t\n  \n"
    assert by_id[76].text == "" and by_id[76].n_chars == 0  # every line stands in 75
    assert by_id[75].text.count("short line") == 1
    assert sum(r.doc_id == 91 and r.text == "same row" for r in out) == 2  # repeated rows are alike


def test_empty_table(spark):
    assert line_links(frame(spark, [])).count() == 0
    assert without_repeated_lines(frame(spark, [])).count() == 0


def test_sets_are_made_once_and_never_written(spark, monkeypatch):
    """The text is read for the sets once, and no table of sets takes disk beside its shuffle."""
    written, made, materialize, sets = [], [], lines.materialize, lines._sets
    monkeypatch.setattr(lines, "materialize", lambda df, name: written.append((name, df)) or materialize(df, name))
    monkeypatch.setattr(lines, "_sets", lambda docs, *more: made.append(docs) or sets(docs, *more))
    assert line_links(frame(spark, rows())).count() > 0
    assert made and all("keys" not in df.columns for _, df in written)
    found = next(df for name, df in written if name == "line-links")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array(array_distinct") == 1


def test_texts_are_hashed_and_cut_once(spark):
    """What stands beside a generator is computed for each of its rows: hashes and cuts of whole texts stand below it."""
    docs = frame(spark, rows()).select("doc_id", "text")

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()
    cut = plan(lines._lines(docs))
    assert -1 < cut.index("Generate") < cut.index("xxhash64(text")
    ranks = lines._ranks(docs)
    classes = lines._classes(docs, ranks)
    sets = plan(lines._sets(docs, classes, classes.select("node"), ranks))
    assert -1 < sets.index("Generate explode(wanted") < sets.index("split(text")


def test_sets_are_sorted_as_plain_numbers(spark):
    docs = frame(spark, rows()).select("doc_id", "text")
    sets = lines._with_keys(lines._lines(docs), lines._ranks(docs))
    assert not sets.schema["keys"].dataType.containsNull  # else each comparison is of objects
    assert all(r["keys"] == sorted(set(r["keys"])) for r in sets.select("keys").collect())


def test_whole_texts_are_lowered_as_their_lines(spark):
    text = "ΟΔΟΣ\nΣ ΑΣ Β\r\n ΑΣ\tΣΑΣ.  İI \n\u000b\n  \nA  B\x0cC"
    got = {r.line_no: r.line for r in lines._lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()}
    each = spark.createDataFrame([(k, " ".join(x.split())) for k, x in enumerate(text.split("\n")) if x.split()], "k long, x string")
    assert got == {r.k: r.x for r in each.selectExpr("k", "lower(x) as x").collect()}
    assert sorted(got) == [0, 1, 2, 5]
