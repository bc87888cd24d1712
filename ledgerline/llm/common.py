"""Helpers of the subpackage: shared tables, words, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import work_dir

#: Spaces between words: blank, tab, line feed, vertical tab, form feed, carriage return. ``bytes.split()`` uses them.
BLANKS = " \t\n\x0b\x0c\r"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here and executors may go."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, label: str, name: str = "row_no") -> DataFrame:
    """Rows with a unique number that stays the same, as it is stored. Keys may repeat or be null; this one doesn't."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), label)


def place() -> Column:
    """Locator of rows that come straight from Parquet files: path and number of the row in it."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"))


def located(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_key``, ``body`` and the locator ``at``. Rows that do not come straight from Parquet are stored first."""
    wanted = F.col(key).alias("doc_key"), F.col(text).alias("body")
    try:
        return docs.select(*wanted, place().alias("at"))
    except AnalysisException:
        copy = stored(docs.select(key, text), "texts")
        return copy.select(*wanted, place().alias("at"))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs``, read from Parquet, without the rows at the places ``gone.at``; columns as before."""
    there = docs.select(F.struct("*").alias("d"), place().alias("here"))
    return there.join(gone.select("at").hint("merge"), F.col("here") == F.col("at"), "left_anti").select("d.*")


def utf8(text: Column) -> Column:
    """Bytes of a text, null as empty."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """Texts in order, about ``most`` bytes at a time."""
    first, held = 0, 0
    for row, size in enumerate(pc.binary_length(texts).to_pylist()):
        held += size
        if held > most:
            yield texts.slice(first, row + 1 - first)
            first, held = row + 1, 0
    if first < len(texts):
        yield texts.slice(first)


def words_of(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts as bytes, with A-Z in lower case if wanted, and the number of words of each text."""
    texts = texts.view(pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words, ends = split.flatten(), split.offsets.to_numpy() - split.offsets[0].as_py()
    there = pc.greater(pc.binary_length(words), 0)  # blanks at either end of a text have an empty word beside them
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    return words.filter(there).view(pa.binary()), np.diff(before[ends])


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def no_clash(df: DataFrame, *added: str) -> None:
    """Raise where a column to be added is there already."""
    there = {c.lower() for c in df.columns}
    if both := [c for c in added if c.lower() in there]:
        raise ValueError(f"columns {both} exist already; rename them first")


def importable(spark: SparkSession) -> None:
    """Python workers on this machine find the package also where it is not installed. A cluster gets it by --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH", ""), root]))
