"""Exact dedup as a stream with keyed state on disk. DataFrame functions only.

Every row becomes an entry: digest of its normalised text, length, identifier and content locator (file and row
number in it). The entries are streamed through an aggregation whose state (RocksDB, no watermark, so nothing
expires) holds for each digest the number of rows and the identifier and locator of the best one. A restart goes
on from the state; later deliveries are compared with all earlier ones. Rows that hit a digest are then compared
byte by byte with the text at the locator; rows that differ are grouped by their whole text instead.

Null text counts as empty; empty texts equal each other. The longest text stays, then the smallest key; a null key
loses against any other; of wholly equal rows the one with the last locator stays. Keys must be integers.
Only key and text are read, whatever the other columns are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import located, stored, without
from ledgerline.session import work_dir

_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else every partition takes 4 MB at once
}


def normalised(text: Column) -> Column:
    """Text without blanks, tabs and line ends; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def entries(rows: DataFrame, digest=sha256) -> DataFrame:
    """What the stream carries for each located row. ``best`` orders rows of a digest; its maximum stays."""
    return rows.select(
        digest(normalised(F.col("body"))).alias("digest"),
        F.struct(
            F.char_length(F.coalesce("body", F.lit(""))).alias("n_points"), F.bitwise_not("doc_key").alias("inverse_key"),
            "at").alias("best"))


def absorb(spark: SparkSession, folder: str, schema, state: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream all new entries of ``folder`` into the state; returns the whole state: digest, n_rows, best.

    Called again with the same ``state`` folder it only reads files that came since.
    """
    before = {k: spark.conf.get(k, None) for k in _STATE}
    try:
        for name, value in _STATE.items():
            spark.conf.set(name, value)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
        held = stream.groupBy("digest").agg(F.count("*").alias("n_rows"), F.max("best").alias("best"))
        query = held.writeStream.format("noop").outputMode("update").option(
            "checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        rows = spark.read.format("statestore").load(state)
        buffers = rows.schema["value"].dataType.fieldNames()
        return stored(rows.select(
            F.col("key.digest").alias("digest"), F.col(f"value.`{buffers[0]}`").alias("n_rows"),
            F.col(f"value.`{buffers[1]}`").alias("best")), "digests")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _differing(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests of rows whose text is not that of the row kept: a collision."""
    texts = rows.select(F.col("at").alias("place"), normalised(F.col("body")).alias("letters"))
    mine = hits.join(texts, F.col("at") == F.col("place")).select("digest", "keep_at", F.col("letters").alias("mine"))
    both = mine.join(texts, F.col("keep_at") == F.col("place"))
    return both.where(F.col("mine") != F.col("letters")).select("digest").distinct()


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256) -> DataFrame:
    """One row per document: ``key``, keep_id, group_size, kept, digest, and the locator ``at``."""
    spark, rows = docs.sparkSession, located(docs, key, text)
    folder = work_dir(spark, "entries")
    entries(rows, digest).write.parquet(folder)
    all_entries = spark.read.parquet(folder)
    state = absorb(spark, folder, all_entries.schema, work_dir(spark, "dedup-state"))
    found = all_entries.join(state.withColumnRenamed("best", "top"), "digest").select(
        "digest", "n_rows", F.col("best.at").alias("at"), F.col("top.at").alias("keep_at"),
        F.bitwise_not("best.inverse_key").alias("doc_key"), F.bitwise_not("top.inverse_key").alias("keep_id"))
    found = stored(found, "found")
    hits = found.where((F.col("n_rows") > 1) & (F.col("at") != F.col("keep_at"))).select("digest", "at", "keep_at")
    collided = stored(_differing(rows, hits), "collided")
    if not collided.isEmpty():
        found = found.join(collided, "digest", "left_anti").unionByName(_by_text(rows, collided, digest))
    return found.select(
        F.col("doc_key").alias(key), "keep_id", F.col("n_rows").alias("group_size"),
        (F.col("at") == F.col("keep_at")).alias("kept"), "digest", "at")


def _by_text(rows: DataFrame, collided: DataFrame, digest) -> DataFrame:
    """Rows of the collided digests, grouped by their whole text."""
    own = entries(rows, digest).select("digest", "best").join(collided, "digest")
    texts = rows.select(F.col("at").alias("place"), normalised(F.col("body")).alias("letters"))
    own = own.join(texts, F.col("best.at") == F.col("place"))
    top = own.groupBy("digest", "letters").agg(F.count("*").alias("n_rows"), F.max("best").alias("top"))
    return own.join(top, ["digest", "letters"]).select(
        "digest", "n_rows", F.col("best.at").alias("at"), F.col("top.at").alias("keep_at"),
        F.bitwise_not("best.inverse_key").alias("doc_key"), F.bitwise_not("top.inverse_key").alias("keep_id"))


def kept_only(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, read from Parquet, without the rows that another one stands for; columns as before."""
    return without(docs, duplicates(docs, key, text).where(~F.col("kept")))
