"""Which landing files are new: a table of the files found, instead of a list in the memory of a stream.

Folders are walked by the driver, their files are listed some folders at a time by Spark, and those that the table does
not have are appended to it, at most ``max_files`` to a file. A stream over the table's files then takes them, one file of
the table to a micro-batch: its state grows with the number of batches and not with the number of landed files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.contracts import SOURCE_FILE

SCHEMA = f"{SOURCE_FILE} STRING, modified_at TIMESTAMP, n_bytes BIGINT"


def readable(file_path: str) -> str:
    """A path from the metadata column as Spark's readers take it: decoded, and no character a wildcard."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file_path))


def folders(spark: SparkSession, landing: str) -> Iterator[str]:
    """Folders below ``landing`` that hold files. What lies below such a folder is listed with it.

    The driver goes through folders, never through the files of one: a folder with a file in it is taken as a whole.
    """
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return
    if not fs.getFileStatus(place).isDirectory():
        yield landing
        return
    waiting = [place]
    while waiting:
        folder = waiting.pop()
        entries = fs.listStatus(folder)
        below = []
        for entry in entries:  # ends with the first file
            if entry.isDirectory():
                below.append(entry.getPath())
            elif not entry.getPath().getName().startswith(("_", ".")):
                yield folder.toString()
                break
        else:
            waiting += below


def listed(spark: SparkSession, places: list[str]) -> DataFrame:
    """The files in and below some folders."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(places).select(
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_size").alias("n_bytes"),
    )


class LandedFiles:
    """The files found so far, each once, by path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def stream(self) -> DataFrame:
        """The table's files, one to a micro-batch."""
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option(
            "maxFileAge", "36500d").parquet(self.path)

    def discover(self, landing: str, max_files: int = 10_000, max_folders: int = 50) -> None:
        """Add the files below ``landing`` that are not known, of any age; ``max_folders`` folders are listed at a time.

        A search that was broken off is simply repeated: what it has added is known.
        """
        group: list[str] = []
        for folder in folders(self.spark, landing):
            group.append(folder)
            if len(group) == max_folders:
                self._add(group, max_files)
                group = []
        if group:
            self._add(group, max_files)

    def _add(self, places: list[str], max_files: int) -> None:
        new = listed(self.spark, places).join(self.read().select(SOURCE_FILE), SOURCE_FILE, "left_anti")
        if new.isEmpty():
            return
        new.select(SOURCE_FILE, "modified_at", "n_bytes").coalesce(1).write.mode("append").option(
            "maxRecordsPerFile", max_files).parquet(self.path)
