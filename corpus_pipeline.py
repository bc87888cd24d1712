"""The corpus pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import best_fit_packing, exact_dedup, jaccard_join, quality_rules, secret_scan
from ledgerline.llm.common import importable, stored


#: Rows in a batch that Python workers get. Spark's 10,000 whole texts take tens of MB in a worker, and as much in the JVM.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def workers(spark: SparkSession) -> None:
    """Python workers find the package and get batches of ``BATCH_ROWS`` rows at most, from now on in this session."""
    importable(spark)
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned list rejects."""
    workers(spark)
    return quality_rules.filtered(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts."""
    return exact_dedup.kept_only(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of near copies: five-word n-grams, similarity 0.8 or more."""
    workers(spark)
    return jaccard_join.one_of_each(docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by a mark."""
    return secret_scan.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens."""
    workers(spark)
    parts = best_fit_packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return best_fit_packing.pack(parts).withColumnRenamed("doc_key", "doc_id")


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("secret scans", secrets),
          ("best-fit packing", packed)]

#: Learned rules, a learned forest and a genetic search: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
