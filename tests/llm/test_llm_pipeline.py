"""The pipeline against plain versions of its stages, and its registration."""

import hashlib

import __spark_entry__
import corpus_pipeline
import numpy as np
from cases import frame, rows
from test_llm_decontamination import brute as hits
from test_llm_lines import brute as lines
from test_llm_simhash import groups, plain
from tokenizers import Tokenizer

from ferrite.llm.bpe import word_bpe_path

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_every_stage_on_its_input(spark):
    docs = corpus_pipeline.table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = corpus_pipeline.materialize(stages["language_id"](spark, docs, SF))
    assert kept.columns == COLUMNS and kept.count() >= 0.98 * docs.count()

    deduped = corpus_pipeline.materialize(stages["line_dedup"](spark, kept, SF))
    assert deduped.columns == COLUMNS
    by_set, linked = lines([(d, t) for d, t in read(kept).items()])
    gone = set()
    for s, members in by_set.items():
        first = min(p for p, _ in members)
        earlier = any(min(p for p, _ in by_set[x]) < first for x in linked[s])
        gone |= {(p[1], p[3]) for p, _ in members if earlier or p != first}
    want = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in read(kept).items()}
    assert read(deduped) == want

    single = corpus_pipeline.materialize(stages["simhash_dedup"](spark, deduped, SF))
    found = groups({d: plain(t) for d, t in want.items()}, 3)
    assert set(read(single)) == {d for d in want if found[d] == d}

    clean = corpus_pipeline.materialize(stages["decontamination"](spark, single, SF))
    items = [(r.item_id, r.text) for r in corpus_pipeline.table(spark, SF, "benchmark").collect()]
    assert set(read(clean)) == {d for d, t in read(single).items() if not hits(t, items)[-1]}

    t = Tokenizer.from_file(word_bpe_path())
    t.no_truncation()
    texts = read(clean)
    for r in stages["bpe"](spark, clean, SF).collect():
        ids = t.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_odd_rows_pass_every_stage(spark):
    for some in (rows(), []):
        docs = frame(spark, some)
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, SF))
            assert name == "bpe" or docs.columns == COLUMNS
        assert (docs.count() > 0) == bool(some)


def test_registered():
    names = set(__spark_entry__.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
