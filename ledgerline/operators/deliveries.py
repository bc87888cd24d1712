"""Reports on deliveries: copies, late arrivals, answer key, rule log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

REACH_DAYS = 7  # a re-sent copy or a late row is looked for this many days back


def per_file(rows: DataFrame, flags: dict[str, Column] | None = None) -> DataFrame:
    """One row per (id, event day, delivery day, file) with the number of copies and the flags.

    Copies collapse on the map side, whatever share of the table one id has.
    """
    return (
        rows.where(F.col("id").isNotNull())
        .groupBy("id", "event_date", "delivery_date", "source_file")
        .agg(
            F.count(F.lit(1)).alias("n_copies"),
            *[F.bool_or(c).alias(name) for name, c in (flags or {}).items()],
        )
    )


def delivery_days(rows: DataFrame) -> DataFrame:
    """Per id and delivery day, the nearest earlier delivery day and whether it is a re-send."""
    days = rows.where(F.col("id").isNotNull()).groupBy("id", "delivery_date").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    earlier = F.lag("delivery_date").over(W.partitionBy("id").orderBy("delivery_date"))
    back = F.date_diff(F.col("delivery_date"), F.col("previous_delivery"))
    return days.withColumn("previous_delivery", earlier).withColumn(
        "is_resent", F.coalesce(back.between(1, REACH_DAYS), F.lit(False))
    )


def resent(rows: DataFrame) -> DataFrame:
    """Deliveries of an id already delivered 1 to 7 days before."""
    return delivery_days(rows).where("is_resent").drop("is_resent")


def classify(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """What is special about each delivery of an id: copies, re-send, delay and the given flags."""
    files = per_file(rows, flags)
    # the same groups carry the look-back: dense days per id, files of one day share it
    days = W.partitionBy("id").orderBy(F.unix_date("delivery_date")).rangeBetween(-REACH_DAYS, -1)
    delay = F.date_diff(F.col("delivery_date"), F.col("event_date"))
    return (
        files.withColumn("is_resent", F.count(F.lit(1)).over(days) > 0)
        .withColumn("in_file_duplicate", F.col("n_copies") > 1)
        .withColumn("days_late", F.when(F.col("is_resent"), 0).otherwise(F.greatest(delay, F.lit(0))))
        .withColumn("is_late", F.col("days_late") > 0)
    )


def late_matrix(rows: DataFrame) -> DataFrame:
    """Rows per event day and delivery day with the delay."""
    return rows.groupBy("event_date", "delivery_date").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "delay_days", F.date_diff("delivery_date", "event_date")
    )


def late_movement(rows: DataFrame) -> DataFrame:
    """Per day: rows on time, rows that left for a later day, rows that arrived from an earlier one."""
    moves = late_matrix(rows)
    legs = F.explode(F.when(
        F.col("delay_days") == 0,
        F.array(F.struct(F.col("delivery_date").alias("day"), F.lit("on_time").alias("leg"))),
    ).otherwise(F.array(
        F.struct(F.col("event_date").alias("day"), F.lit("left").alias("leg")),
        F.struct(F.col("delivery_date").alias("day"), F.lit("arrived").alias("leg")),
    )))
    counted = [
        F.sum(F.when(F.col("_leg.leg") == leg, F.col("n_rows")).otherwise(0)).alias(name)
        for leg, name in [("on_time", "n_on_time"), ("left", "n_left_late"), ("arrived", "n_arrived_late")]
    ]
    return (
        moves.withColumn("_leg", legs)
        .groupBy(F.col("_leg.day").alias("day"))
        .agg(*counted)
        .withColumn("n_delivered", F.col("n_on_time") + F.col("n_arrived_late"))
    )


def conservation(rows: DataFrame) -> DataFrame:
    """How many ids were delivered how often, not counting copies in a file and re-sends."""
    return (
        delivery_days(rows)
        .groupBy("id")
        .agg(F.count_if(~F.col("is_resent")).alias("n_deliveries"))
        .groupBy("n_deliveries")
        .agg(F.count(F.lit(1)).alias("n_ids"))
    )


def reconcile(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Compare two lists of (kind, id) on distinct ids: expected, found, missing and extra per kind.

    Both lists are reduced to one row per (kind, id) by an aggregation, no join is needed.
    """
    both = expected.select("kind", "id", F.lit(1).alias("_e"), F.lit(0).alias("_f")).unionByName(
        found.select("kind", "id", F.lit(0).alias("_e"), F.lit(1).alias("_f"))
    )
    return (
        both.groupBy("kind", "id")
        .agg(F.max("_e").alias("_e"), F.max("_f").alias("_f"))
        .groupBy("kind")
        .agg(
            F.sum("_e").alias("n_expected"),
            F.sum("_f").alias("n_found"),
            F.count_if((F.col("_e") == 1) & (F.col("_f") == 0)).alias("n_missing"),
            F.count_if((F.col("_e") == 0) & (F.col("_f") == 1)).alias("n_extra"),
        )
    )


# Shape of the rule counters inside an event log row.
EXPECTATIONS = "array<struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>>"
EXPECTATIONS_PATH = "$.flow_progress.data_quality.expectations"


def rule_log(counts: DataFrame, run: str, dataset: Column, at: Column,
             by: list[str] | None = None) -> DataFrame:
    """Rule counters as event log rows: a row per run (and ``by``) with its few rules in ``details``.

    ``at`` is an aggregate or a constant.
    """
    line = F.struct(
        F.col("rule").alias("name"), dataset.alias("dataset"),
        F.col("passed").alias("passed_records"), F.col("failed").alias("failed_records"),
    )
    packed = counts.groupBy(F.col(run).alias("_run"), *(by or [])).agg(
        F.collect_list(line).alias("_lines"), at.alias("_at"))
    details = F.to_json(F.struct(F.struct(F.struct(
        F.col("_lines").alias("expectations")
    ).alias("data_quality")).alias("flow_progress")))
    return packed.select(
        F.col("_at").alias("timestamp"),
        F.struct(F.col("_run").alias("update_id")).alias("origin"),
        F.lit("flow_progress").alias("event_type"),
        details.alias("details"),
    )


def quality_metrics(log: DataFrame) -> DataFrame:
    """Passed, failed and percentage failed per run, table and rule, from the event log."""
    found = F.get_json_object("details", EXPECTATIONS_PATH)
    lines = (
        log.where((F.col("event_type") == "flow_progress") & found.isNotNull())
        .select(
            "timestamp",
            F.col("origin.update_id").alias("run_id"),
            F.explode(F.from_json(found, EXPECTATIONS)).alias("_e"),
        )
    )
    passed, failed = F.sum("_e.passed_records"), F.sum("_e.failed_records")
    return lines.groupBy(
        "run_id",
        F.regexp_extract("_e.dataset", r"([^.]+)$", 1).alias("table_name"),
        F.col("_e.name").alias("rule"),
    ).agg(
        F.max("timestamp").alias("measured_at"),
        passed.alias("passed"),
        failed.alias("failed"),
        F.round(
            F.lit(100.0) * failed / F.nullif(passed + failed, F.lit(0)), 4
        ).alias("pct_failed"),
    )
