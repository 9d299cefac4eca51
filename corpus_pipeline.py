"""A corpus pipeline over ``documents``: language ID, line dedup, near-dedup, decontamination, BPE.

Each stage takes all that the one before kept; its result is written as
Parquet and read back before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, common, decontaminate, language, lines, minhash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no language go; a null lang is filled in."""
    return language.known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of two or more lines go from the texts, and documents of which nothing is left."""
    return lines.without_repeated_runs(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays."""
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.clean(docs, common.load(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become token ids, with a digest of what they decode to."""
    return bpe.encoded_documents(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("bpe", tokens)]

#: Languages, minhashes and token ids are beyond SQL; tests/llm holds each stage's operator against a plain version,
#: and of run() checks ids, columns and token counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs = common.load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
