"""The registered queries of the text operators: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (byte_bpe, chat, chosen_path, decontaminate, filter_audit, packing, prefix_trie, pu_quality, rules, substrings,
               suffix_tree, token_counts, warc)
from .common import staged, table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op2_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return chosen_path.join(table(spark, d, "documents")).drop("sig", "root")


@query
def op3_chat_format(spark: SparkSession, d: str) -> DataFrame:
    """Digests of all conversations, formatted and read back; conversation -7 shows the escaping."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"))
    vocabulary = tokenizer_path(VOCABULARY)
    formatted = chat.format_turns(turns.unionByName(tricky), vocabulary)
    return chat.digests(chat.read_turns(formatted, vocabulary))


@query
def op4_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return pu_quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op5_token_packing(spark: SparkSession, d: str) -> DataFrame:
    """Documents as ids, packed and written; then one row per segment, read back."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    path = scratch_path(spark, "packed")
    packing.write_packed(packing.pack_texts(docs, tokenizer_path(VOCABULARY)), path)
    return packing.segments(spark.read.parquet(path))


@query
def op6_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = tokenizer_path(VOCABULARY)
    docs = table(spark, d, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, vocabulary).drop("text")
    both = byte_bpe.decode(encoded, vocabulary)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op7_warc_bundles(spark: SparkSession, d: str) -> DataFrame:
    """All pages written as bundles; then every record, read back through manifest and seek tables."""
    folder = scratch_path(spark, "warc")
    manifest = staged(warc.write_bundles(table(spark, d, "pages"), folder, min_bytes=0), "warc-manifest")
    return warc.read_records(manifest, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_compact_windows(spark: SparkSession, d: str) -> DataFrame:
    return substrings.passages(table(spark, d, "documents"))


@query
def op9_suffix_tree(spark: SparkSession, d: str) -> DataFrame:
    return suffix_tree.score(table(spark, d, "documents"))


@query
def op10_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    judged = rules.judge(table(spark, d, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "failed_rules")


@query
def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    """Every node of the trie of all conversations, each rebuilt with the first turns of its block of 20 ids."""
    return prefix_trie.trie(table(spark, d, "conversations"), shared=prefix_trie.SHARED).drop("key", "parent")


@query
def op12_token_counts(spark: SparkSession, d: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, d, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op13_filter_audit(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))
