"""Small notes beside a table: what is complete, what is published. Each is one file, there as a whole or not at all.

They are read by the driver through Hadoop's file systems, without a Spark job; a table has few of them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, place: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, place: str) -> bool:
    path, fs = _path(spark, place)
    return fs.exists(path)


def write(spark: SparkSession, place: str, content: dict) -> None:
    """Write a note that must not be there yet: written aside, then renamed."""
    path, fs = _path(spark, place)
    aside, _ = _path(spark, f"{path.getParent().toString()}/.{path.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    if fs.exists(path) or not fs.rename(aside, path):
        fs.delete(aside, False)
        raise FileExistsError(place)


def read(spark: SparkSession, place: str) -> dict | None:
    path, fs = _path(spark, place)
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there. Hidden ones are left out."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if not n.startswith("."))


def last(spark: SparkSession, folder: str, label: str) -> int:
    """The highest N of the finished Spark outputs ``label=N`` in a folder, -1 if there is none."""
    numbers = sorted((int(n.split("=")[1]) for n in names(spark, folder) if n.startswith(f"{label}=")), reverse=True)
    return next((n for n in numbers if exists(spark, f"{folder}/{label}={n}/_SUCCESS")), -1)
