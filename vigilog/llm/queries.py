"""The registered queries of this folder and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.llm import sql
from vigilog.llm.common import read_documents
from vigilog.llm.conversation_trie import KEY, listed_digests, ordered_turns, prefix_trie, rebuilt
from vigilog.llm.decontamination import judged
from vigilog.llm.fill_in_middle import fill_in_middle, restored
from vigilog.llm.jaccard_join import jaccard_components
from vigilog.llm.language_id import language_id
from vigilog.llm.lm_scoring import score_documents
from vigilog.llm.quality_classifier import CUT, held_out, learn, quality_score
from vigilog.llm.quality_rules import quality_rules
from vigilog.llm.secret_scans import BASE_KINDS, secret_spans, written
from vigilog.llm.sentencepiece_viterbi import encode_and_decode, read_model
from vigilog.llm.sharding import shard_documents
from vigilog.llm.token_file import read_token_file, tokenizer_json, write_token_file
from vigilog.llm.url_filters import url_filters
from vigilog.session import scratch_dir


class Query(NamedTuple):
    job: Callable
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, text: str | None = None):
    def register(job):
        QUERIES[name] = Query(job, text)
        return job

    return register


@query("op1_quality_rules", sql.QUALITY_RULES)
def _quality_rules(spark, sf_dir) -> DataFrame:
    judged = quality_rules(read_documents(spark, sf_dir, "doc_id", "text"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("op4_ngram_jaccard_join")
def _ngram_jaccard_join(spark, sf_dir) -> DataFrame:
    return jaccard_components(read_documents(spark, sf_dir, "doc_id", "text"))


@query("op3_benchmark_decontamination")
def _benchmark_decontamination(spark, sf_dir) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = judged(read_documents(spark, sf_dir, "doc_id", "text"), items)
    return found.select("doc_id", "leaked", F.array_join("leaked_items", ",").alias("item_ids"), "similarity")


def _count(kind: str):
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


@query("op5_secret_scans")
def _secret_scans(spark, sf_dir) -> DataFrame:
    found = read_documents(spark, sf_dir, "doc_id", "text").withColumn("found", secret_spans(F.col("text"))).drop("text")
    counts = {f"n_{k}": _count(k) for k in BASE_KINDS}
    base = F.sha2(written(F.col("found"), BASE_KINDS).cast("binary"), 256)
    return found.withColumns(counts | {"base_sha256": base, "spans": written(F.col("found"))}).drop("found")


@query("op9_sentencepiece")
def _sentencepiece(spark, sf_dir) -> DataFrame:
    """Ids of every text, what they decode to, and whether that is the text."""
    coded = read_documents(spark, sf_dir, "doc_id", "text").withColumn("coded", encode_and_decode(F.col("text"), read_model()))
    return coded.select(
        "doc_id",
        F.size("coded.ids").cast("long").alias("n_tokens"),
        F.xxhash64("coded.ids").alias("ids_hash"),
        F.length("coded.decoded").cast("long").alias("decoded_chars"),
        F.col("coded.decoded").eqNullSafe(F.col("text")).alias("exact"),
    )


@query("op2_url_filters", sql.URL_FILTERS)
def _url_filters(spark, sf_dir) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_filters(pages).drop("url")


@query("op6_language_id")
def _language_id(spark, sf_dir) -> DataFrame:
    return language_id(read_documents(spark, sf_dir, "doc_id", "text", "lang"))


@query("op8_sharding")
def _sharding(spark, sf_dir) -> DataFrame:
    placed = shard_documents(read_documents(spark, sf_dir, "doc_id", "text"))
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op10_token_file")
def _token_file(spark, sf_dir) -> DataFrame:
    path = scratch_dir(spark, "token-file")
    write_token_file(read_documents(spark, sf_dir, "doc_id", "text"), path, tokenizer_json())
    return read_token_file(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op7_lm_scoring")
def _lm_scoring(spark, sf_dir) -> DataFrame:
    return score_documents(read_documents(spark, sf_dir, "doc_id", "text"))


@query("op11_quality_classifier")
def _quality_classifier(spark, sf_dir) -> DataFrame:
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


@query("op12_fill_in_middle", sql.FILL_IN_MIDDLE)
def _fill_in_middle(spark, sf_dir) -> DataFrame:
    cut = fill_in_middle(read_documents(spark, sf_dir, "doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


@query("op13_conversation_trie", sql.CONVERSATION_TRIE)
def _conversation_trie(spark, sf_dir) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    nodes, ends = prefix_trie(*rebuilt(*ordered_turns(conversations)))
    counts = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    listed = F.coalesce("sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return nodes.join(listed_digests(ends), KEY, "left").select(F.col("conv").alias("conv_id"), "depth", *counts, listed)
