"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where an aggregate on the same key follows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "ledgerline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect; keywords use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder path below the shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is chosen only where the setting is absent, as in local tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("ledgerline.work.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="ledgerline-")
        spark.conf.set("ledgerline.work.dir", base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove)
    _made.append((spark, path))
    return path


_made: list[tuple[SparkSession, str]] = []


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _remove() -> None:
    """Work folders go with the program that made them, if its session is still there."""
    for spark, path in _made:
        with suppress(Exception):
            delete_folder(spark, path)
