"""Corpus pipeline: five stages over ``documents``, each one of the training-data operators.

``run`` writes each stage's rows as Parquet in the shared folder and rereads them as the
next stage's documents.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import bpe, decontam, jaccard_join, line_dedup, repetition
from rowtide.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the repetition rules."""
    return repetition.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came, or nearly came, earlier; documents that lose every line go."""
    return line_dedup.drop_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return jaccard_join.keep_first(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item and no 13 words of one in a row, re-parameterised ones included."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"), min_run=13, meet=True)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the token ids and of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL has no byte-level BPE; tests hold the pipeline against brute-force versions of the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
