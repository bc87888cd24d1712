"""Draws that depend only on a seed and the row, so any run and any row order gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.functions.scalars import digest, draw


def exact_rate(df: DataFrame, day: str, key: str, rate: float, seed: str) -> DataFrame:
    """For every day exactly ``round(n * rate)`` rows (half to even), chosen by digest of the key.

    Instead of ranking a whole day in one group, the digests are counted by their first three hex
    digits. Those counts give, per day, the slot in which the quota ends: rows in lower slots are
    in, rows in higher slots are out, and the rows of that one slot are ranked. No group is larger
    than a slot, a 4096th of its day.
    The table of slots has one row per day. ``key`` must be unique. Rows without a day are a day of their own.
    """
    drawn = df.withColumn("_digest", digest(seed, F.col(key))).withColumn(
        "_slot", F.substring("_digest", 1, 3)
    )
    by_slot = W.partitionBy(day).orderBy("_slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = (
        drawn.groupBy(day, "_slot")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(by_slot))
        .withColumn("_quota", F.bround(F.sum("_n").over(W.partitionBy(day)) * F.lit(rate)).cast("bigint"))
        .where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
        .select(F.col(day).alias("_day"), F.col("_slot").alias("_end"), (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left"))
    )
    slot = W.partitionBy(day, "_slot").orderBy("_digest", key)
    return (
        drawn.join(ends, F.col(day).eqNullSafe(F.col("_day")))
        .where(F.col("_slot") <= F.col("_end"))  # from here on little more than the sample is left
        .withColumn("_rn", F.row_number().over(slot))
        .where((F.col("_slot") < F.col("_end")) | (F.col("_rn") <= F.col("_left")))
        .select(*df.columns)
    )


def weighted(seed: str, weights: list[tuple[str, int]], *key: Column) -> Column:
    """One of the names, with probability proportional to its weight."""
    point = draw(seed, sum(w for _, w in weights), *key)
    ladder, upto = None, 0
    for name, weight in weights[:-1]:
        upto += weight
        ladder = F.when(point < upto, name) if ladder is None else ladder.when(point < upto, name)
    return F.lit(weights[0][0]) if ladder is None else ladder.otherwise(weights[-1][0])


def device_type(use_chip: Column, key: Column, seed: str = "device") -> Column:
    """``mobile`` or ``web`` for online sales, else ``pos``; stable per transaction."""
    online = F.when(draw(seed, 2, key) == 0, "mobile").otherwise("web")
    return F.when(use_chip == "Online Transaction", online).otherwise("pos")


def pseudonyms(df: DataFrame, key: str, secret: str) -> DataFrame:
    """Identifying columns replaced by values that follow from the key and a secret.

    The same key gets the same pseudonym in every table, and without the secret nobody can tell whose it is. The
    address is in a domain that cannot exist; a null key has no pseudonym.
    """
    token = F.substring(F.sha2(F.concat_ws("|", F.lit(secret), F.col(key)).cast("binary"), 256), 1, 16)
    token = F.when(F.col(key).isNotNull(), token)
    return df.withColumns({
        "name": F.concat(F.lit("person-"), token), "ssn": F.lit(None).cast("string"),
        "email": F.concat(token, F.lit("@pseudonym.invalid")),
    })
