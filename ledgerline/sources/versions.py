"""Tables that are replaced as a whole.

Plain Parquet overwrite deletes first and writes then. Here the new content is written to a folder beside the old one
and becomes visible by the last step, a small entry that names it. A reader sees either the old or the new content,
whole. The folder before the current one stays for readers that have begun; older ones are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import delete_folder

_REGISTER = "version BIGINT, upto BIGINT, folder STRING, published_at TIMESTAMP"


class ReplacedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entries(self) -> DataFrame:
        try:
            return self.spark.read.option("recursiveFileLookup", True).schema(_REGISTER).json(
                f"{self.path}/register")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _REGISTER)

    def latest(self) -> Row | None:
        """Entry of the current content, or None before the first one. ``upto`` is the last input batch it holds."""
        return self._entries().orderBy(F.desc("version")).first()

    def publish(self, df: DataFrame, upto: int = -1) -> int:
        """Write ``df`` as the new content, then announce it. ``df`` may read the current one.

        A folder belongs to one attempt only. A table has one writer at a time: a second one that comes later fails,
        but two that announce at the very same moment could both succeed, as the file system only checks and writes.
        """
        now = self.latest()
        version = now.version + 1 if now else 1
        folder = f"version={version:08d}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.path}/data/{folder}")
        self._announce(version, upto, folder)
        for old in self._entries().where(F.col("version") < version - 1).collect():
            delete_folder(self.spark, f"{self.path}/register/{old.version:08d}")
            delete_folder(self.spark, f"{self.path}/data/{old.folder}")
        return version

    def _announce(self, version: int, upto: int, folder: str) -> None:
        note = self.spark.range(1).select(
            F.lit(version).cast("bigint").alias("version"), F.lit(upto).cast("bigint").alias("upto"),
            F.lit(folder).alias("folder"), F.current_timestamp().alias("published_at"),
        )
        note.write.mode("errorifexists").json(f"{self.path}/register/{version:08d}")

    def read(self) -> DataFrame:
        """The current content."""
        entry = self.latest()
        if entry is None:
            raise FileNotFoundError(f"nothing published in {self.path}")
        return self.at(entry)

    def at(self, entry: Row) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/data/{entry.folder}")
