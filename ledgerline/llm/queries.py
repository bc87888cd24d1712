"""The registered queries of the subpackage. Each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    best_fit_packing, byte_bpe, exact_dedup, filter_audit, jaccard_join, line_dedup, lm_trie, prefix_trie, quality_rules,
    secret_scan, token_counts, toxicity, warc_zstd,
)
from ledgerline.llm.common import importable

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return fn(spark, lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    REGISTRY[fn.__name__] = run
    return run


@query
def op1_quality_rules(spark, table):
    return quality_rules.judged(table("documents"), table("labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query
def op2_byte_bpe(spark, table):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = table("documents").select("doc_id", byte_bpe.encode(F.col("text"), path, pattern).alias("ids"))
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(byte_bpe.ids_text(F.col("ids")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), path, pattern), 256).alias("decoded_sha256"))


@query
def op3_token_counts(spark, table):
    return token_counts.counted(table("documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "*", (F.col("n_tokens") > 2048).alias("over_limit"))


@query
def op4_secret_scan(spark, table):
    return secret_scan.findings(table("documents")).select(
        F.col("doc_key").alias("doc_id"), "number", F.col("start").cast("bigint").alias("start"),
        F.char_length("candidate").cast("bigint").alias("length"), "candidate", "score", "secret")


@query
def op5_line_dedup(spark, table):
    return line_dedup.without_passages(table("documents"))


@query
def op6_best_fit_packing(spark, table):
    parts = best_fit_packing.pieces(table("documents"), public_tokenizers.path("word_bpe_49k.json"))
    return best_fit_packing.pack(parts).withColumnRenamed("doc_key", "doc_id")


@query
def op7_exact_dedup(spark, table):
    return exact_dedup.duplicates(table("documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query
def op8_warc_zstd(spark, table):
    return warc_zstd.read_archives(warc_zstd.write_archives(table("pages")), with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query
def op9_lm_trie(spark, table):
    return lm_trie.scored(table("documents"), order=3, min_count=1)


@query
def op10_ngram_jaccard_join(spark, table):
    return jaccard_join.linked_groups(table("documents"), k=3, percent=90).select(
        F.col("doc_key").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


@query
def op11_toxicity(spark, table):
    return toxicity.scored(table("documents"), table("labels"))


@query
def op12_filter_audit(spark, table):
    return filter_audit.audit(table("documents"), table("labels"))


@query
def op13_prefix_trie(spark, table):
    return prefix_trie.trie(table("conversations"))
