import re
from collections import Counter

from cases import clashing, frame, rows

from ferrite.llm import quality as Q
from ferrite.llm.quality import BASE_FIGURES, RULES, Figures, Rule, kept, ordered, plan, with_verdict

BLANK = "[\\x20\\x09-\\x0D]"
ODD = ["", " \n\t", "a a a a", "a b c a b c", "x\n\nx\n x\nx\r\nx", "## a|b <c> $%&*", "A BB CC! dd ÉÉ 1 2", "- a\n* b\n• c\n d...\n e… \n",
       "éü 中文 \U0001f642 x", "a\x1fb\x85c", "word " * 400_000, "z" * 1_500_000]


def brute(text):
    words = [w for w in re.split(BLANK + "+", text or "") if w]
    lines = [l for l in (text or "").split("\n") if re.search("[^\\x20\\x09-\\x0D]", l)]
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit), "n_lines": len(lines),
            "n_bullet_lines": sum(bool(re.match(BLANK + "*[-*•]", l)) for l in lines),
            "n_cut_lines": sum(bool(re.search("(\\.\\.\\.|…)" + BLANK + "*$", l)) for l in lines),
            "letter_counts": (sum(not re.search("[A-Za-z]|[^\\x00-\\x7f]", w) for w in words),
                              sum(len(re.findall("[A-Z]", w)) > 1 and not re.search("[a-z]", w) for w in words))}


def test_figures():
    for text in ODD + [r[1] for r in rows()]:
        t = Figures((text or "").encode())
        for name, value in brute(text).items():
            assert getattr(t, name) == value, (name, text and text[:50])


def verdict(text):
    class Plain:
        pass
    t = Plain()
    t.__dict__.update(brute(text))
    return not any(r.rejects(t) for r in RULES)


def test_verdicts(spark):
    some = rows() + [(300 + i, t, "en", "s", len(t)) for i, t in enumerate(ODD)]
    docs = frame(spark, some)
    steps = plan(docs)
    assert sorted(s.rule.name for s in steps) == sorted(r.name for r in RULES)
    want = Counter((d, t and len(t), verdict(t)) for d, t, *_ in some)
    assert set(k[2] for k in want) == {True, False}
    for order in (steps, steps[::-1]):  # the order changes no verdict
        got = with_verdict(docs, order, BASE_FIGURES).collect()
        assert Counter((r.doc_id, r.text and len(r.text), r.kept) for r in got) == want
        for r in got:
            assert {f: r[f] for f in BASE_FIGURES} == {f: v for f, v in brute(r.text).items() if f in BASE_FIGURES}
            assert r.kept == (r.failed_rule is None) and 1 <= r.n_tested <= len(RULES)
    names = clashing(spark, "kept", "N_words", "failed_rule")
    assert kept(names).columns == names.columns and kept(names).count() == sum(verdict(r[1]) for r in rows())
    assert with_verdict(names, steps, ("n_words",)).columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "failed_rule", "n_tested", "kept"]


def test_empty_table(spark):
    docs = frame(spark, [])
    assert len(plan(docs)) == len(RULES) and kept(docs).count() == 0


def test_order_is_rejections_for_cost():
    def rule(name, *needs):
        return Rule(name, needs, lambda t: False)
    rules = [rule("dear", "x"), rule("cheap", "n_words"), rule("late", "n_words", "n_symbols"), rule("never", "n_symbols")]
    cost = {"x": 10.0, "n_words": 1.0, "n_symbols": 2.0}
    # by mask: 0 dear, 1 cheap, 2 late, 3 never
    steps = ordered(rules, {0b0001: 60, 0b0010: 5, 0b0110: 20, 0b0100: 10, 0: 5}, cost)
    assert [s.rule.name for s in steps] == ["cheap", "dear", "late", "never"]
    assert [round(s.rejected, 3) for s in steps] == [0.25, 0.8, round(10 / 15, 3), 0.0]
    assert [s.cost for s in steps] == [1.0, 10.0, 2.0, 0.0]  # words and symbols are made by then
    # a figure that is made anyway costs its rules nothing
    assert ordered(rules, {0b0001: 1, 0b0010: 9}, cost, given=["x"])[0].rule.name == "dear"


def test_sample_is_a_part_of_large_tables(spark):
    docs = frame(spark, rows() * 20)
    steps = plan(docs, sample_rows=200)
    assert [s.rule.name for s in steps] and all(0 <= s.rejected <= 1 for s in steps)
    assert kept(docs).count() == 20 * sum(verdict(r[1]) for r in rows())
    assert Q.SAMPLE_ROWS == 2000
