import numpy as np
import pytest
from cases import clashing, frame
from pyspark.sql import functions as F

from ferrite.llm import language
from ferrite.llm.common import table
from ferrite.llm.language import codewords, fit, identified, op6_language_codes, profile, with_language


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 12])
def test_codewords_are_apart(n):
    code = codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    assert len({tuple(r) for r in code}) == n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = op6_language_codes(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").collect()
    out = [r.lang_pred == r.lang for r in got if r.held_out]
    assert len(out) > 100 and np.mean(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got) and len(got) == 1000


@pytest.mark.parametrize("languages", [["en", "de"], ["en", "de", "es", "fr"]])
def test_mixed_texts_are_ambiguous_and_clean_ones_are_not(spark, languages):
    docs = table(spark, "/root/testdata/sf0.01", "documents").filter(F.col("lang").isin(languages))
    model = fit(docs)
    clean = {l: [r.text for r in docs.filter(language.held_out() & (F.col("lang") == l) & (F.length("text") > 200)).collect()] for l in languages}
    mixed = []
    for a, b in zip(languages[::2], languages[1::2]):
        for x, y in zip(clean[a], clean[b]):
            n = min(len(x), len(y))
            mixed.append(model.predict(f"{x[:n]} {y[:n]}")[2])
    kept = [not model.predict(t)[2] for texts in clean.values() for t in texts]
    print(languages, model.least_margin, len(mixed), "mixed, flagged", np.mean(mixed), len(kept), "clean, kept", np.mean(kept))
    assert len(mixed) > 10 and np.mean(mixed) > 0.5
    assert len(kept) > 50 and np.mean(kept) > 0.98


def test_profile_does_not_depend_on_segments(monkeypatch):
    text = "\u00e9 Hello w\u00f6rld, again " * 400
    whole = profile(text)
    monkeypatch.setattr(language, "_SEGMENT", 97)
    assert np.allclose(profile(text), whole)


def test_odd_texts_and_clashes(spark):
    docs = clashing(spark, "Score", "lang_pred")
    got = identified(docs, fit(docs)).collect()
    by_id = {r.doc_id: r for r in got}
    for d in (80, 81, 82, 84):
        assert (by_id[d].lang_pred, by_id[d].score, by_id[d].ambiguous) == ("und", 0.0, True)
    assert by_id[1].lang_pred in ("de", "en", "fr")
    kept = with_language(docs)
    assert kept.columns == docs.columns and {80, 81, 82, 84} & {r.doc_id for r in kept.collect()} == set()


def test_no_labels_and_empty_table(spark):
    some = [(1, "hello there", None, "s", 11)]
    assert [r.lang_pred for r in identified(frame(spark, some), fit(frame(spark, some))).collect()] == ["und"]
    assert with_language(frame(spark, [])).count() == 0
