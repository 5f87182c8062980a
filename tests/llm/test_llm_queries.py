"""Every registered query over a given table: columns, row counts and digests."""

import hashlib

import duckdb
import pytest

from ferrite.llm.common import table
from ferrite.llm.pii import detect, spans
from ferrite.llm.queries import REGISTRY, SQL

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_shuffle_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op2_line_set_join": ["doc_id", "line_no", "n_links", "class_doc_id", "class_line_no", "removed"],
    "op3_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op4_pivot_permutations": ["vec_id", "n_links", "component_id", "kept"],
    "op5_bpe_chunks": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_language_codes": ["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
    "op7_pii_deobfuscated": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
    "op8_license_windows": ["doc_id", "n_matches", "licenses", "spans"],
    "op9_html_density": ["page_id", "url", "text", "n_chars"],
    "op10_simhash_bktree": ["doc_id", "fingerprint", "component_id"],
    "op11_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op12_pivotal_grams": ["word", "form", "root", "n", "n_near", "form_n"],
    "op13_quality_cascade": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    got = REGISTRY[name](spark, SF)
    assert got.columns == COLUMNS[name]
    rows = got.collect()
    source = {"op4": "embeddings", "op9": "pages"}.get(name.split("_")[0], "documents")
    if name == "op12_pivotal_grams":
        assert rows and len({r.word for r in rows}) == len(rows)
    elif name != "op2_line_set_join":
        assert len(rows) == table(spark, SF, source).count()
    else:
        texts = [r.text for r in table(spark, SF, source).collect()]
        assert len(rows) == sum(bool(line.strip()) for t in texts for line in t.split("\n"))


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = REGISTRY[name](spark, SF)
    want = con.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, [list(r) for r in got.select(*want.columns).collect()])) == \
        sorted(map(str, [list(r) for r in want.fetchall()]))


def test_pii_digests(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    seen = 0
    for r in REGISTRY["op7_pii_deobfuscated"](spark, SF).collect():
        base = detect(texts[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in base) for x in ("email", "ip", "card", "phone")]
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans(texts[r.doc_id]))
        seen += len(base)
    assert seen


def test_shard_sizes_and_checks(spark):
    rows = REGISTRY["op1_shuffle_shards"](spark, SF).collect()
    texts = {r.doc_id: r.text.encode() for r in table(spark, SF, "documents").collect()}
    import zlib
    assert all((r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in rows)
    sizes = [sum(r.shard == s for r in rows) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
