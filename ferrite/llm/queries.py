"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from ferrite.llm import decontamination, embeddings, lines, merkle, quality, spelling
from ferrite.llm.bpe import op5_bpe_chunks
from ferrite.llm.decontamination import op3_decontaminate
from ferrite.llm.embeddings import op4_pivot_permutations
from ferrite.llm.html import op9_html_density
from ferrite.llm.language import op6_language_codes
from ferrite.llm.licenses import op8_license_windows
from ferrite.llm.lines import op2_line_set_join
from ferrite.llm.pii import op7_pii_deobfuscated
from ferrite.llm.sharding import op1_shuffle_shards
from ferrite.llm.simhash import op10_simhash_bktree

REGISTRY = {
    "op1_shuffle_shards": op1_shuffle_shards,
    "op2_line_set_join": op2_line_set_join,
    "op3_decontaminate": op3_decontaminate,
    "op4_pivot_permutations": op4_pivot_permutations,
    "op5_bpe_chunks": op5_bpe_chunks,
    "op6_language_codes": op6_language_codes,
    "op7_pii_deobfuscated": op7_pii_deobfuscated,
    "op8_license_windows": op8_license_windows,
    "op9_html_density": op9_html_density,
    "op10_simhash_bktree": op10_simhash_bktree,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_pivotal_grams": spelling.op12_pivotal_grams,
    "op13_quality_cascade": quality.op13_quality_cascade,
}

#: Shuffles, trained models, tokenizers, rolling hashes and XXH64 have no SQL
#: twin; tests/llm holds each of their queries against a brute-force version.
SQL: dict[str, str] = {
    "op2_line_set_join": lines.SQL,
    "op3_decontaminate": decontamination.SQL,
    "op4_pivot_permutations": embeddings.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_pivotal_grams": spelling.SQL,
    "op13_quality_cascade": quality.SQL,
}
