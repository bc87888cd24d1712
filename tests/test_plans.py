"""What the plans must look like to hold on large tables."""

import pytest

from ledgerline.plans.queries import REGISTRY

SMALL = "/root/testdata/sf0.001"
BATCH = [n for n in REGISTRY if not n.startswith(("bronze_", "silver_")) and n not in (
    "schema_evolution", "rescued_data", "snapshot_reload")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_and_no_python_rows(spark, name):
    text = plan(REGISTRY[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["scd1_transactions", "scd1_cards", "state_as_of"])
def test_one_row_per_key_before_the_shuffle(spark, name):
    text = plan(REGISTRY[name](spark, SMALL))
    assert "1, Partial" in text and "1, Final" in text


def test_history_shuffles_its_rows_once(spark):
    """Without a hot key nothing is left of the branches that serve hot keys."""
    df = REGISTRY["scd2_clients"](spark, SMALL)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert sum("Exchange hashpartitioning" in line for line in final.splitlines()) == 1
    assert "SortAggregate" not in final


def test_partitions_and_columns_are_pruned(spark):
    text = plan(REGISTRY["partition_pruned_scan"](spark, SMALL))
    assert "PartitionFilters: [month_year" in text.replace("isnotnull(month_year", "[month_year") or "month_year#" in text
    assert "o_totalprice" not in text


def test_sample_shuffles_counts_and_the_last_slot_only(spark):
    text = plan(REGISTRY["sample_exact_rate"](spark, SMALL))
    assert "Window [row_number()" in text and "_digest" in text
    assert "SortMergeJoin" not in text


def test_a_hot_card_is_split_over_tasks(spark):
    """Where the cards are too large to broadcast, the sort-merge join splits the rows of a hot card."""
    from pyspark.sql import functions as F

    from ledgerline.operators import lookups

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        hot = F.when(F.col("id") % 3 == 0, "7").otherwise((F.col("id") % 5000).cast("string"))
        tx = spark.range(200_000, numPartitions=8).select("id", hot.alias("card_id"))
        cards = spark.range(4000).select(F.col("id").cast("string").alias("id"))
        df = lookups.card_exists(tx, cards)
        found = sum(r.card_exists for r in df.collect())
        assert found == sum(n % 3 == 0 or n % 5000 < 4000 for n in range(200_000))
        assert "SortMergeJoin(skew=true)" in plan(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_large_folder_is_split_over_files(spark, root):
    """One month holds nearly all rows: it is written by several tasks, the small ones by one each."""
    import glob

    from pyspark.sql import functions as F

    from ledgerline.sources import files

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64KB")
    try:
        month = F.when(F.col("id") % 100 < 98, "2017-01").otherwise(F.concat(F.lit("2017-0"), (F.col("id") % 100 - 96).cast("string")))
        df = spark.range(300_000, numPartitions=8).select("id", month.alias("month_year"))
        files.write_partitioned(df, root, "month_year")
    finally:
        spark.conf.unset(key)
    assert len(glob.glob(f"{root}/month_year=2017-01/*.parquet")) > 3
    assert len(glob.glob(f"{root}/month_year=2017-02/*.parquet")) == 1
    assert spark.read.parquet(root).count() == 300_000
