"""From raw documents to packed training sequences, in five stages.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame. :func:`run` applies them to ``documents``,
writing each result as Parquet to the shared folder and reading it again.

1. ``language_id``: documents whose language cannot be told go.
2. ``line_dedup``: lines that repeat an earlier line, exactly or within one
   edit, are cut out; a document left without text goes.
3. ``jaccard_join``: of each group of near-duplicate documents one stays.
4. ``mix_sources``: documents are repeated or left out so that each source
   reaches its target share of the words.
5. ``best_fit_packing``: the rows are the pieces of the documents, each with
   its sequence and place.

All stages but the last return the columns of their input. Nulls, empty and
very long texts, repeated rows and empty tables are handled by each operator
as its own docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import jaccard_join, language_id, line_dedup, mixing, packing
from ledgerlake.llm.common import delete, prepare, scratch, table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language_id.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return line_dedup.drop_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Tokenisation and the trained language model have no SQL form;
#: tests/llm/test_pipeline.py holds the chained stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the whole ``documents`` table. What a stage wrote on
    its way goes when its result is written, and its input with it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark, keep=[f"stage-{name}"]):
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            delete(spark, before)
        before = docs.inputFiles()[0].rsplit("/", 1)[0] if docs.inputFiles() else None
    return docs
