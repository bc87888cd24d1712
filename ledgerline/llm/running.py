"""Running totals along sorted groups of any size.

A window keeps a group in one task. Here rows are dealt out by ranges of (key, order), so a group that holds a third of
all rows lies in many tasks; each task runs over its own rows, and what a group has before a task begins is added from a
table of one row per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import map_batches, stored

ADD, XOR = "add", "xor"
_FOLD = {ADD: (np.add, np.subtract), XOR: (np.bitwise_xor, np.bitwise_xor)}


def _runner(key: str, totals: dict[str, tuple[str, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, last, carry = 0, None, dict.fromkeys(totals, np.int64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            n = len(keys)
            starts = np.flatnonzero(np.concatenate([[last is None or keys[0] != last], keys[1:] != keys[:-1]]))
            group = np.searchsorted(starts, np.arange(n), side="right") - 1  # -1: goes on from the batch before
            columns = {c: batch.column(c) for c in batch.schema.names}
            for out, (value, kind) in totals.items():
                add, back = _FOLD[kind]
                along = add.accumulate(batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64))
                before = np.concatenate([[0], along])[starts]
                along = np.where(group < 0, add(along, carry[out]), back(along, before[group]) if len(starts) else along)
                carry[out] = along[-1]
                columns[out] = pa.array(along)
            columns["_row"] = pa.array(np.arange(seen, seen + n))
            seen, last = seen + n, keys[-1]
            yield pa.record_batch(columns)
    return run


def running(df: DataFrame, key: str, order: list[str], totals: dict[str, tuple[str, str]], label: str) -> DataFrame:
    """``df`` with running totals per ``key`` along ``order``, the row itself included.

    ``totals`` maps new columns to (column of whole numbers, ``ADD`` or ``XOR``). ``key`` is a whole number, never null;
    rows of equal key and order stand in any order. The result is stored. ``df`` is read twice (ranges are drawn from a
    sample, which decides on the work only), so it should be a stored table.
    """
    spark, fields = df.sparkSession, df.schema.fields
    dealt = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order).withColumn("_task", F.spark_partition_id())
    extra = [T.StructField("_task", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in (*totals, "_row"))]
    local = stored(map_batches(dealt, _runner(key, totals), T.StructType([*fields, *extra])), label)
    # only the first and the last key of a task can lie in other tasks too
    ends = local.groupBy("_task").agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
    edges = local.join(F.broadcast(ends), "_task").where(F.col(key).isin(F.col("_low"), F.col("_high"))).groupBy(key, "_task").agg(
        *[F.max_by(c, "_row").alias(c) for c in totals])
    earlier = W.partitionBy(key).orderBy("_task").rowsBetween(W.unboundedPreceding, -1)
    fold = {ADD: F.sum, XOR: F.bit_xor}
    offsets = edges.select(F.col(key).alias("_key"), F.col("_task").alias("_at"), F.row_number().over(
        W.partitionBy(key).orderBy("_task")).alias("_nth"), *[fold[k](c).over(earlier).alias(f"_{c}") for c, (_, k) in totals.items()])
    small = stored(offsets.where("_nth > 1"), f"{label}-offsets")  # at most one row per task
    both = local.join(F.broadcast(small), (F.col(key) == F.col("_key")) & (F.col("_task") == F.col("_at")), "left")
    whole = {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) if k == ADD else F.col(c).bitwiseXOR(F.coalesce(f"_{c}", F.lit(0)))
             for c, (_, k) in totals.items()}
    return both.select(*[f.name for f in fields], *[v.alias(c) for c, v in whole.items()])
