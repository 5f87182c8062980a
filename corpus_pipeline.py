"""A training-data pipeline over ``documents``: five operators of ferrite.llm in turn.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared folder and reads it back as the next
stage's input.  All stages but the last return the columns of documents.
Nulls, empty and long texts, ties, repeated rows, empty tables and further
columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferrite.llm.bpe import encoded, digests, word_bpe_path
from ferrite.llm.common import table
from ferrite.llm.decontamination import decontaminated
from ferrite.llm.language import with_language
from ferrite.llm.lines import without_repeated_lines
from ferrite.llm.simhash import one_of_each
from ferrite.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those without letters or ambiguous go."""
    return with_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that repeat an earlier line or nearly do."""
    return without_repeated_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passages to speak of."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of the decoded text."""
    return digests(encoded(docs.select("doc_id", "text"), word_bpe_path()))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: Trained classifiers, graph reachability and a tokenizer have no SQL twin;
#: tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
