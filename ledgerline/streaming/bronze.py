"""Incremental file ingestion into append-only Bronze logs.

New files are found by path, noted in a table of landed files and taken exactly once (a stream over
that table, with a checkpoint). A micro-batch is written to a folder of its own, ``log/batch_id=N``,
so a repeated batch replaces its own output only.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline import contracts as k
from ledgerline.operators.conform import truncate_pan
from ledgerline.sources import drift, notes
from ledgerline.sources.landing import LandedFiles, listed, readable


#: Completion markers are taken whatever their age; the default would pass over files a week older than the newest.
ANY_AGE = "36500d"


class NewColumns(Exception):
    """Files hold columns that are not in the registered schema."""


@dataclass(frozen=True)
class Entity:
    name: str
    fmt: str  # json or csv
    columns: list[str]
    keep_rescued: bool = True
    prepare: Callable[[DataFrame], DataFrame] | None = None  # applied before anything is stored
    stored: list[str] = field(default_factory=list)  # contract columns after ``prepare``


TRANSACTIONS = Entity("transactions", "json", k.TRANSACTION_COLUMNS)
CLIENTS = Entity("clients", "csv", k.CLIENT_COLUMNS)
# a rescued line could hold a card number, so cards keep none
CARDS = Entity("cards", "csv", k.CARD_COLUMNS, keep_rescued=False, prepare=truncate_pan)


class ColumnRegister:
    """Known column names of an entity, one file per widening."""

    def __init__(self, spark: SparkSession, path: str, initial: list[str]):
        self.spark, self.path, self.initial = spark, path, initial

    def versions(self) -> list[list[str]]:
        schema = "version INT, names ARRAY<STRING>"
        try:
            rows = (
                self.spark.read.option("recursiveFileLookup", True).schema(schema).json(self.path)
                .orderBy("version").collect()
            )
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [r.names for r in rows]

    def names(self) -> list[str]:
        known = self.versions()
        return known[-1] if known else list(self.initial)

    def widen(self, new: list[str]) -> None:
        version = len(self.versions()) + 1
        names = self.names() + [n for n in new if n not in self.names()]
        row = self.spark.range(1).select(
            F.lit(version).alias("version"), F.array(*[F.lit(n) for n in names]).alias("names")
        )
        row.write.mode("errorifexists").json(f"{self.path}/{version:08d}")


class BronzeLog:
    """All deliveries of one entity as they came, every column text, with lineage.

    A full refresh of an entity is a new ``generation``: new folders and a new checkpoint.
    """

    def __init__(self, spark: SparkSession, entity: Entity, root: str, generation: int = 1):
        self.spark, self.entity = spark, entity
        base = f"{root.rstrip('/')}/{entity.name}/generation={generation}"
        self.log, self.checkpoint, self.done = f"{base}/log", f"{base}/checkpoint", f"{base}/batches"
        self.landed = LandedFiles(spark, f"{base}/landed")
        self.register = ColumnRegister(spark, f"{base}/columns", entity.columns)

    def schema(self) -> str:
        names = self.register.names()
        if self.entity.prepare:
            empty = self.spark.createDataFrame([], ", ".join(f"`{n}` STRING" for n in names))
            names = self.entity.prepare(empty).columns
        text = list(names) + ([k.RESCUED] if self.entity.keep_rescued else []) + [k.SOURCE_FILE]
        return ", ".join(f"`{n}` STRING" for n in text) + f", {k.INGESTED_AT} TIMESTAMP"

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{schema}, batch_id BIGINT").parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{schema}, batch_id BIGINT")

    def batches(self) -> DataFrame:
        """Completed micro-batches with their rows, and how many of those had unknown columns."""
        return self._read(self.done, "n_rows BIGINT, n_strange BIGINT")

    def last_batch(self) -> int:
        return notes.last(self.spark, self.done, "batch_id")

    def read(self) -> DataFrame:
        """All complete batches, with the schema taken from the register and not from the files."""
        return self._read(self.log, self.schema()).where(F.col("batch_id") <= self.last_batch())

    def committed(self, **options) -> DataFrame:
        """The completion markers as a stream: one row per batch that is wholly written, and no other."""
        schema = "n_rows BIGINT, n_strange BIGINT, batch_id BIGINT"
        return self.spark.readStream.schema(schema).option("maxFileAge", ANY_AGE).options(**options).parquet(self.done)

    def rows_of(self, batch_ids: list[int]) -> DataFrame:
        """Rows of some complete batches; the condition prunes folders."""
        return self._read(self.log, self.schema()).where(F.col("batch_id").isin(batch_ids))

    def ingest(self, landing: str, on_new_columns: str = drift.ADD, max_files: int = 10_000) -> None:
        """Take every file below ``landing`` not taken before, of any age, then stop.

        On an unknown column: ``add`` registers it, fails the attempt and starts again, so the
        column is filled from its first row; ``rescue`` keeps it in ``rescued_data``; ``fail``
        stops until someone registers it; ``ignore`` drops it.
        """
        if on_new_columns not in drift.POLICIES:
            raise ValueError(f"on_new_columns must be one of {drift.POLICIES}")
        while True:  # every repetition has registered a column, so there are no more of them than columns
            known = len(self.register.versions())
            try:
                self._drain(landing, on_new_columns, max_files)
                return
            except StreamingQueryException:
                if len(self.register.versions()) == known:
                    raise

    def _drain(self, landing: str, policy: str, max_files: int) -> None:
        self.landed.discover(landing, max_files)
        if self.landed.read().isEmpty():
            return
        (
            self.landed.stream().writeStream.foreachBatch(lambda files, n: self._store(self._lines(files), n, policy))
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    def _lines(self, files: DataFrame) -> DataFrame:
        """Lines of the files of a micro-batch, at most ``max_files`` of them."""
        paths = [readable(r[0]) for r in files.select(k.SOURCE_FILE).collect()]
        if not paths:
            return self.spark.createDataFrame([], f"value STRING, {k.SOURCE_FILE} STRING, block_start BIGINT")
        return self.spark.read.text(paths).select(
            "value", F.col("_metadata.file_path").alias(k.SOURCE_FILE), F.col("_metadata.file_block_start").alias("block_start"))

    def _store(self, batch: DataFrame, batch_id: int, policy: str) -> None:
        """Write a micro-batch; one pass over JSON files, for CSV files one more for the headers."""
        if batch_id <= self.last_batch():
            return  # done before a restart
        known = self.register.names()
        lines = batch.where(F.trim("value") != "")
        if self.entity.fmt == "json":
            fields = lines.withColumn("fields", drift.json_fields(F.col("value")))
        else:
            fields = drift.csv_rows(self.spark, drift.csv_headers(lines))
        rows = fields.withColumn("outside", drift.outside(F.col("fields"), known))
        unknown = Observation()
        strange = F.size("outside") > F.when(F.map_contains_key("outside", drift.CORRUPT), 1).otherwise(0)
        out = drift.project(
            rows.observe(unknown, F.count(F.lit(1)).alias("n_rows"), F.count_if(strange).alias("n_strange")),
            known, policy, [k.SOURCE_FILE])
        if not self.entity.keep_rescued:
            out = out.drop(k.RESCUED)
        if self.entity.prepare:
            out = self.entity.prepare(out)
        out = out.withColumn(k.INGESTED_AT, F.current_timestamp())
        folder = f"{self.log}/batch_id={batch_id}"
        out.write.mode("overwrite").parquet(folder)
        seen = unknown.get
        if policy in (drift.ADD, drift.FAIL) and seen["n_strange"]:
            new = drift.new_names(rows)
            # too many names are data used as keys: they stay in rescued_data, and the feed goes on
            if policy == drift.FAIL or len(new) <= drift.MAX_NEW:
                # the batch is taken back and repeated as a whole once its columns are known
                out.where(F.lit(False)).write.mode("overwrite").parquet(folder)
                if policy == drift.ADD:
                    self.register.widen(new)
                raise NewColumns(f"{self.entity.name}: {', '.join(new[:20])}")
        self.spark.range(1).coalesce(1).select(
            F.lit(seen["n_rows"]).cast("bigint").alias("n_rows"),
            F.lit(seen["n_strange"]).cast("bigint").alias("n_strange"),
        ).write.mode("overwrite").parquet(f"{self.done}/batch_id={batch_id}")  # one file, so it is there or not

    def _taken(self) -> DataFrame:
        return self.read().groupBy(k.SOURCE_FILE).agg(F.max(k.INGESTED_AT).alias("taken_at"))

    def ignored_corrections(self, landing: str) -> DataFrame:
        """Files rewritten under the same name after they were taken; the stream never looks again."""
        return listed(self.spark, [landing]).join(self._taken(), k.SOURCE_FILE).where("modified_at > taken_at")

    def untaken(self, landing: str) -> DataFrame:
        """Files below ``landing`` of which the log holds no row: not ingested yet, or without rows."""
        return listed(self.spark, [landing]).join(self._taken(), k.SOURCE_FILE, "left_anti")
