"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3): every
query runs once to warm up and then BENCH_RUNS times; the median counts. Results go to a sink that
keeps nothing, so all rows and columns are computed. ``python bench.py volume`` instead measures the
published operations at their published volumes, on rows derived from ``events``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import functions as F

from ledgerline.plans import queries
from ledgerline.plans.queries import REGISTRY
from ledgerline.session import build_session, work_dir
from ledgerline.sources import files, snapshots

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "typed_transactions", "card_lookup", "rule_counts", "quarantine_tx", "quality_metrics",
    "scd1_transactions", "scd1_cards", "scd2_clients", "state_as_of", "fact_asof_dim",
    "classify_deliveries", "reconcile_answer_key", "late_matrix", "label_coverage", "orphans_lineitem",
    "key_profile", "refund_pairs", "sample_exact_rate", "volume_gross_net", "fact_transactions",
    "map_explode_labels", "partition_pruned_scan", "dynamic_overwrite", "bronze_tx_stream", "silver_transactions",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def median(job, runs: int = RUNS) -> float:
    job()
    times = []
    for _ in range(runs):
        started = time.perf_counter()
        job()
        times.append(time.perf_counter() - started)
    return round(statistics.median(times), 3)


def session():
    spark = build_session(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("OFF")
    return spark


def registered() -> dict:
    spark = session()
    months = queries._monthly_orders(spark, SF_DIR)  # staged outside of the timed part
    jobs = {n: lambda n=n: drain(REGISTRY[n](spark, SF_DIR)) for n in HEADLINE}
    jobs["partition_pruned_scan"] = lambda: drain(queries.pruned_window(spark, months))
    timed = {n: median(job) for n, job in jobs.items()}
    return {
        "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }


def volume() -> dict:
    """13.3 M transactions over 34 months and 8.9 M labels, as in the published measurements."""
    spark = session()
    root = work_dir(spark, "volume")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    copies = 13_305_915 // events.count() + 1
    day = F.date_add(F.lit("2017-01-01").cast("date"), (F.xxhash64("event_id", "copy") % 517 + 517).cast("int"))
    tx = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).select(
        (F.col("event_id") * copies + F.col("copy")).cast("string").alias("id"),
        F.concat(day.cast("string"), F.lit(" "), F.date_format("ts", "HH:mm:ss")).alias("date"),
        F.col("user_id").cast("string").alias("client_id"), F.col("user_id").cast("string").alias("card_id"),
        F.concat(F.lit("$"), F.col("value").cast("decimal(12,2)").cast("string")).alias("amount"),
        F.col("event_type").alias("use_chip"), F.lit("58523.0").alias("zip"), F.lit("5812").alias("mcc"))
    names = tx.columns
    tx.write.option("header", True).csv(f"{root}/csv")
    flat = files.read_csv(spark, f"{root}/csv", names)
    files.write_partitioned(flat.withColumn("month_year", F.substring("date", 1, 7)), f"{root}/months", "month_year")
    label_rows = spark.range(8_914_963).select(F.concat(
        F.lit('"'), F.col("id").cast("string"), F.lit('": "'), F.when(F.col("id") % 669 == 0, "Yes").otherwise("No"),
        F.lit('"')).alias("value"))
    label_rows.write.option("lineSep", ", ").text(f"{root}/label-pieces")
    with open(f"{root}/labels.json", "wb") as whole:  # one object in one file, as delivered
        whole.write(b'{"target": {')
        parts = sorted(p for p in os.listdir(f"{root}/label-pieces") if p.startswith("part-"))
        for n, part in enumerate(parts):
            with open(f"{root}/label-pieces/{part}", "rb") as piece:
                data = piece.read()
            whole.write(data if n + 1 < len(parts) else data.rstrip(b", "))
        whole.write(b"}}")

    wanted = F.substring("date", 1, 10) == "2018-05-17"
    months = spark.read.parquet(f"{root}/months")
    timed = {
        "day_from_csv": median(lambda: flat.where(wanted).count()),
        "day_from_months": median(
            lambda: months.where((F.col("month_year") == "2018-05") & wanted).count()),
        "labels_map_write": median(
            lambda: snapshots.read_labels_map(spark, f"{root}/labels.json").write.mode("overwrite").parquet(f"{root}/labels-a")),
        "labels_explode_write": median(
            lambda: snapshots.read_labels(spark, f"{root}/labels.json").write.mode("overwrite").parquet(
                f"{root}/labels-b")),
        "count_by_year": median(lambda: drain(flat.groupBy(F.substring("date", 1, 4).alias("y")).count())),
    }
    rows = {"tx": flat.count(), "labels": spark.read.parquet(f"{root}/labels-b").count()}
    assert rows["labels"] == spark.read.parquet(f"{root}/labels-a").count() == 8_914_963
    return {"metric": "published_volume", "unit": "sec", "rows": rows, "queries": timed}


if __name__ == "__main__":
    print(json.dumps(volume() if sys.argv[1:] == ["volume"] else registered()))
