"""Joins: existence lookup, orphans, enrichment, coverage, signed pairs.

No side is broadcast by hint: Spark broadcasts a side only when its measured size is under the
session's threshold, and adaptive execution splits skewed sides of the other joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def card_exists(rows: DataFrame, cards: DataFrame, card_key: str = "id") -> DataFrame:
    """Left lookup of ``card_id`` in the current cards, one row per key there."""
    known = cards.select(F.col(card_key).alias("_known"))
    return (
        rows.join(known, F.col("card_id") == F.col("_known"), "left")
        .withColumn("card_exists", F.col("_known").isNotNull())
        .drop("_known")
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys of ``child`` absent from ``parent``, with their number of rows.

    The child is reduced to its keys first, so a key with many rows costs one row in the join.
    """
    keys = child.groupBy(F.col(child_key).alias("orphan_key")).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key).alias("_known")).distinct()
    return keys.join(known, F.col("orphan_key") == F.col("_known"), "left_anti")


def enrich(rows: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Left join on equally named keys; ``other`` must hold one row per key."""
    return rows.join(other, on=on, how="left")


def label_coverage(facts: DataFrame, key: str, group: Column, labels: DataFrame,
                   label_key: str, label: str) -> DataFrame:
    """Rows and labelled rows per group. Facts are counted per (key, group) before the join."""
    counted = facts.groupBy(F.col(key).alias("_key"), group.alias("grp")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    known = labels.select(F.col(label_key).alias("_lkey"), F.col(label).alias("_label"))
    return (
        counted.join(known, F.col("_key") == F.col("_lkey"), "left")
        .groupBy("grp")
        .agg(
            F.sum("_n").alias("n_rows"),
            F.sum(F.when(F.col("_label").isNotNull(), F.col("_n")).otherwise(0)).alias("n_labelled"),
            F.sum(F.when(F.col("_label"), F.col("_n")).otherwise(0)).alias("n_positive"),
        )
    )


def refund_pairs(rows: DataFrame, keys: list[str], amount: str = "amount") -> DataFrame:
    """Refunds matched one to one with purchases of the same keys and opposite amount.

    Counted per group, never as a list of all combinations.
    """
    sized = rows.where(F.col(amount) != 0).withColumn("abs_amount", F.abs(F.col(amount)))
    return (
        sized.groupBy(*keys, "abs_amount")
        .agg(
            F.count_if(F.col(amount) > 0).alias("n_purchases"),
            F.count_if(F.col(amount) < 0).alias("n_refunds"),
        )
        .where((F.col("n_purchases") > 0) & (F.col("n_refunds") > 0))
        .withColumn("n_pairs", F.least("n_purchases", "n_refunds"))
    )
