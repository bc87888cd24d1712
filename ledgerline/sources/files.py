"""Batch scans and writes of the landing formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def text_schema(columns: list[str]) -> str:
    return ", ".join(f"`{c}` STRING" for c in columns)


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header. With ``columns`` nothing is inferred and every value stays text."""
    reader = spark.read.option("header", True)
    if columns:
        reader = reader.schema(text_schema(columns))
    return reader.option("inferSchema", infer).csv(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None,
              multi_line: bool = False, recursive: bool = False) -> DataFrame:
    """JSON Lines, or one object per file with ``multi_line``.

    ``recursive`` reads mixed folder layouts and makes no partition columns out of their names.
    """
    reader = spark.read.option("multiLine", multi_line)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def write_partitioned(df: DataFrame, path: str, column: str, fmt: str = "parquet",
                      replace_days_only: bool = False, **options) -> None:
    """Overwrite a table in folders by ``column``, with files of a sensible size.

    The rebalance hint gathers the rows of a folder into one file and splits a folder that holds
    far more than the others, so one large value does not become one task. With
    ``replace_days_only`` only the folders present in ``df`` are replaced; the option is set on
    this write and does not depend on the session.
    """
    writer = df.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column)
    if replace_days_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.options(**options).format(fmt).save(path)


def write_json_days(df: DataFrame, path: str, column: str = "date_partition") -> None:
    """Daily JSON files; NULL fields are written, so that a missing value can be told from a missing key."""
    write_partitioned(df, path, column, "json", replace_days_only=True, ignoreNullFields=False)


def write_csv_days(df: DataFrame, path: str, column: str = "date_partition") -> None:
    write_partitioned(df, path, column, "csv", replace_days_only=True, header=True)


def write_small_csv(df: DataFrame, path: str) -> None:
    """CSV in as few files as the size allows (one for a small table)."""
    df.hint("rebalance").write.mode("overwrite").option("header", True).csv(path)


def file_stats(df: DataFrame) -> DataFrame:
    """Number of files, bytes and rows of a table read from files."""
    per_file = df.groupBy(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")
    ).agg(F.count(F.lit(1)).alias("_n"))
    return per_file.agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("_size").alias("n_bytes"), F.sum("_n").alias("n_rows")
    )


def create_layers(spark: SparkSession, prefix: str) -> list[str]:
    """One database per layer, each below ``prefix`` so that environments do not mix."""
    names = [f"{prefix}_{layer}" for layer in ("landing", "bronze", "silver", "gold", "ops")]
    for name in names:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:name)", args={"name": name})
    return names
