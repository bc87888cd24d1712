"""Profiling checks of a table, each a single aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, NULL keys and whether the key is unique.

    Rows are counted per key first, which keeps repeated keys out of the shuffle.
    """
    per_key = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.count("_k").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).alias("n_null"),
        (F.coalesce(F.max("_n"), F.lit(0)) <= 1).alias("is_unique"),
    )


def extent(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def count_by(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Rows per value, most frequent first."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"))


def numeric_order(df: DataFrame, key: str) -> DataFrame:
    """Sort by the number in a text key; texts that are no number come first.

    Rows of equal key keep their order. That also lets Spark cut the rows of a frequent key into
    several ranges.
    """
    return (
        df.withColumn("key_number", F.col(key).try_cast("bigint"))
        .withColumn("_at", F.monotonically_increasing_id())
        .orderBy("key_number", key, "_at")
        .drop("_at")
    )


def placed(ordered: DataFrame, path: str) -> DataFrame:
    """Rows of a sorted table with their ``place`` from 1; ``path`` is an unused folder.

    A sorted table lies in ranges, one to a task. They are stored with the number of each row in its range, and the
    sizes of the ranges before, a row per range, are added.
    """
    number = F.monotonically_increasing_id()  # the task's number, then 33 bits for the row in it
    ordered.withColumns({"_range": F.shiftright(number, 33), "_row": number.bitwiseAND(F.lit((1 << 33) - 1))}).write.parquet(path)
    rows = ordered.sparkSession.read.parquet(path)
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_before"))  # as many rows as the sort had tasks
    return rows.join(F.broadcast(starts), "_range").withColumn("place", F.col("_before") + F.col("_row") + 1).drop(
        "_range", "_row", "_before")


def split_period(df: DataFrame, column: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """Rows before and from ``cut``, by text comparison of an ISO date. NULL dates are in neither."""
    return df.where(F.col(column) < cut), df.where(F.col(column) >= cut)


def split_report(df: DataFrame, column: str, cut: str) -> DataFrame:
    """Counts of both sides and of the whole, to show that nothing is lost or doubled."""
    before, after = F.count_if(F.col(column) < cut), F.count_if(F.col(column) >= cut)
    return df.agg(
        F.count(F.lit(1)).alias("n_total"), before.alias("n_before"), after.alias("n_after"),
        (F.count(F.lit(1)) == before + after).alias("is_complete"),
    )


def parts_report(whole: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Whether two stored parts are the whole, row for row and as often, in any order.

    Rows are compared as multisets: by their number and the sums of two 64-bit hashes of all columns, the parts' taken
    from the whole's. A lost row and a doubled one cancel in the count and not in the sums.
    """
    def hashed(df: DataFrame, part: str) -> DataFrame:
        columns = [F.col(c) for c in whole.columns]
        return df.select(
            F.lit(part).alias("part"), F.xxhash64(*columns).cast("decimal(38,0)").alias("x"),
            F.xxhash64(F.lit("second"), *reversed(columns)).cast("decimal(38,0)").alias("y"))

    rows = hashed(whole, "whole").unionByName(hashed(before, "before")).unionByName(hashed(after, "after"))
    is_whole = F.col("part") == "whole"
    sign = F.when(is_whole, 1).otherwise(-1)
    return rows.agg(
        F.count_if(is_whole).alias("n_total"), F.count_if(F.col("part") == "before").alias("n_before"),
        F.count_if(F.col("part") == "after").alias("n_after"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"_{n}") for n, c in (("n", sign), ("x", sign * F.col("x")), ("y", sign * F.col("y")))],
    ).select("n_total", "n_before", "n_after", ((F.col("_n") == 0) & (F.col("_x") == 0) & (F.col("_y") == 0)).alias("is_complete"))


def check_day(day: str, first: str = "2017-01-01", last: str = "2019-10-31") -> str:
    """Refuse a processing day outside the accepted range, before any job starts."""
    from datetime import date

    parsed = date.fromisoformat(day)
    if not date.fromisoformat(first) <= parsed <= date.fromisoformat(last):
        raise ValueError(f"day {day} is outside the accepted range {first} - {last}")
    return day
