"""From raw documents to token ids: good texts, one of each group of near copies, no benchmark passages, no secrets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigilog.llm.decontamination import keep_clean
from vigilog.llm.jaccard_join import keep_one_of_each
from vigilog.llm.quality_rules import keep_good
from vigilog.llm.secret_scans import redact_secrets
from vigilog.llm.sentencepiece_viterbi import read_model, with_pieces
from vigilog.session import drop_scratch, scratch_dir, scratch_dropped


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a shingle similarity of 0.8, the one of least id."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind."""
    return redact_secrets(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, as decoded from their token ids, and these ids."""
    return with_pieces(docs, read_model())


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scans", secrets),
    ("sentencepiece", tokens),
]

#: Similarity groups, fingerprints and token ids have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again, and dropped when the next one's is there."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        with scratch_dropped(spark):  # what the stage itself has written on its way
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            drop_scratch(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
