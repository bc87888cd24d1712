"""Keyed tables in folders by hash bucket of the key.

A change rewrites the buckets of its keys and no other: their new content is written below a folder of its own,
``data/folder=.../bucket=...``, in one partitioned write, and becomes visible by the last step, a small entry that says
which buckets are now found there. Readers see every bucket either as before or as after. A bucket's former content stays
for readers that have begun and goes with the next change after that.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import delete_folder
from ledgerline.sources import notes

BUCKET, FOLDER = "bucket", "folder"


@dataclass(frozen=True)
class State:
    """What is published: the folder of each bucket and how far the table's inputs went in."""

    version: int
    n_buckets: int
    folders: dict[int, str]
    marks: dict[str, int]


class BucketedTable:
    """``split`` are further partition columns below the bucket. ``n_buckets`` holds from the first write on.

    The number of buckets bounds what the driver knows of the table. It should grow with the table that is expected, so
    that a bucket is some hundred megabytes; a bucket's content is written in as many files as its size asks for.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], n_buckets: int = 64, split: list[str] | None = None):
        self.spark, self.path, self.keys, self.split = spark, path.rstrip("/"), keys, split or []
        self.n_buckets = n_buckets

    def state(self) -> State | None:
        found = [notes.read(self.spark, f"{self.path}/register/{name}") for name in notes.names(self.spark, f"{self.path}/register")]
        folders: dict[int, str] = {}
        for note in found:
            folders.update(dict.fromkeys(note["buckets"], note["folder"]))
            for bucket in note["emptied"]:
                folders.pop(bucket, None)
        return State(found[-1]["version"], found[-1]["n_buckets"], folders, found[-1]["marks"]) if found else None

    def bucket(self, state: State | None) -> Column:
        n = state.n_buckets if state else self.n_buckets
        return F.pmod(F.hash(*[F.col(c) for c in self.keys]), F.lit(n)).cast("int")

    def touched(self, df: DataFrame, state: State | None) -> list[int]:
        """The buckets of some rows' keys."""
        return sorted(r[0] for r in df.select(self.bucket(state)).distinct().collect())

    def read(self, state: State | None, schema: T.StructType, buckets: list[int] | None = None,
             but: list[int] | None = None) -> DataFrame:
        """Rows of some buckets, of all, or of all ``but`` some; folders of the others are not scanned."""
        wanted = [] if state is None else [
            b for b in state.folders if (buckets is None or b in buckets) and b not in (but or ())]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        places = T.StructType([*schema.fields, T.StructField(FOLDER, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        return self.spark.read.schema(places).option("basePath", f"{self.path}/data").parquet(
            *[self._place(state.folders[b], b) for b in sorted(wanted)]).drop(FOLDER, BUCKET)

    def _place(self, folder: str, bucket: int) -> str:
        return f"{self.path}/data/{FOLDER}={folder}/{BUCKET}={bucket}"

    def replace(self, df: DataFrame, buckets: list[int], state: State | None, marks: dict[str, int]) -> None:
        """``df`` as the new content of ``buckets``; it may read the present one. One writer at a time, as in
        :class:`~ledgerline.sources.versions.ReplacedTable`."""
        version = state.version + 1 if state else 1
        folder = f"{version:08d}-{uuid.uuid4().hex}"
        rows = df.withColumn(BUCKET, self.bucket(state))
        places = [BUCKET, *self.split]
        rows.hint("rebalance", *[F.col(c) for c in places]).write.mode("errorifexists").partitionBy(*places).parquet(
            f"{self.path}/data/{FOLDER}={folder}")
        filled = [b for b in buckets if notes.exists(self.spark, self._place(folder, b))]
        notes.write(self.spark, f"{self.path}/register/{version:08d}.json", {
            "version": version, "folder": folder, "n_buckets": state.n_buckets if state else self.n_buckets,
            "buckets": filled, "emptied": [b for b in buckets if b not in filled], "marks": marks})
        self._clean(version, set(state.folders.values()) if state else set())

    def _clean(self, version: int, before: set[str]) -> None:
        """Delete folders that neither the present content nor the one before refers to."""
        live = before | set(self.state().folders.values())
        for name in notes.names(self.spark, f"{self.path}/register"):
            note = notes.read(self.spark, f"{self.path}/register/{name}")
            if note["version"] < version and note["folder"] not in live:
                delete_folder(self.spark, f"{self.path}/data/{FOLDER}={note['folder']}")
                delete_folder(self.spark, f"{self.path}/register/{name}")
