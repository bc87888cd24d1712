"""Keyed tables in buckets, merges of the buckets that changed, pinned lookups, requeued rows, histories out of order."""

import datetime
import random

import pytest
from pyspark.sql import functions as F
from test_bronze import put_json, tx
from test_silver import Landed, lake  # noqa: F401

from ledgerline.operators import expectations, history
from ledgerline.sources.buckets import BucketedTable
from ledgerline.streaming import silver


def files_of(df):
    return {f.split("/data/")[1] for f in df.inputFiles()}


def log_batches(df):
    """Batches of the log whose files are read."""
    return {r[0] for r in df.select(F.regexp_extract(F.input_file_name(), "/log/batch_id=([0-9]+)/", 1)).distinct().collect()}


def test_only_the_touched_buckets_are_read_and_written(spark, root):
    table = BucketedTable(spark, root, ["id"], n_buckets=8)
    schema = spark.createDataFrame([], "id BIGINT, v STRING").schema
    whole = spark.range(1000).select("id", F.lit("a").alias("v"))
    table.replace(whole, table.touched(whole, None), None, {"batch": 0})
    first = table.state()
    assert len(first.folders) == 8 and table.read(first, schema).count() == 1000

    fresh = spark.createDataFrame([(5, "b"), (5000, "b")], schema)
    touched = table.touched(fresh, first)
    old = table.read(first, schema, buckets=touched)
    assert len(touched) <= 2 and len({f.split("bucket=")[1].split("/")[0] for f in files_of(old)}) == len(touched)
    merged = history.latest(old.withColumn("n", F.lit(0)).unionByName(fresh.withColumn("n", F.lit(1))), ["id"], ["n"]).drop("n")
    table.replace(merged, touched, first, {"batch": 1})

    second = table.state()
    got = {r.id: r.v for r in table.read(second, schema).collect()}
    assert got == {**dict.fromkeys(range(1000), "a"), 5: "b", 5000: "b"}
    assert second.marks == {"batch": 1} and {b for b in range(8) if first.folders[b] != second.folders[b]} == set(touched)
    untouched = table.read(second, schema, but=touched)
    assert files_of(untouched) == files_of(table.read(first, schema, but=touched))
    plan = untouched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # a reader of the former content still finds it
    assert table.read(first, schema).where("v = 'b'").count() == 0


def test_former_folders_go_when_nothing_refers_to_them(spark, root):
    table = BucketedTable(spark, root, ["id"], n_buckets=2)
    df = spark.range(10).select("id")
    for batch in range(4):
        table.replace(df, [0, 1], table.state(), {"batch": batch})
    names = {r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.parquet").load(f"{root}/data").select(F.regexp_extract("path", "folder=([0-9]+)", 1)).collect()}
    assert names == {"00000003", "00000004"}
    assert table.read(table.state(), df.schema).count() == 10


def test_a_merge_does_not_read_the_log_or_other_buckets(lake):  # noqa: F811
    lake.transactions.table.n_buckets = 8
    lake.land_cards("c", ["2"])
    lake.land_tx("t1", [tx(n) for n in range(200)])
    lake.transactions.compact()
    lake.land_tx("t2", [tx(7, amount="$1.00")])
    state = lake.transactions.table.state()
    fresh = lake.transactions._fresh(state, 1, -1)
    touched = lake.transactions.table.touched(fresh, state)
    changed = lake.transactions._changed(state, fresh, touched)
    assert {f.split("bucket=")[1].split("/")[0] for f in changed.inputFiles() if "/table/data/" in f} == {str(touched[0])}
    assert log_batches(fresh) == {"1"}
    before = lake.transactions.table.state().folders
    lake.transactions.compact()
    after = lake.transactions.table.state().folders
    assert [b for b in after if after[b] != before[b]] == touched
    assert {r.id: float(r.amount) for r in lake.transactions.read().collect()}["7"] == 1.0


def test_history_of_any_arrival_order_equals_one_fold(spark):
    """Records come in batches in any order; only versions and absorbed records are kept between them."""
    tracked, order = ["v"], ["at", "tie"]
    schema = "id STRING, at TIMESTAMP, tie BIGINT, v STRING, note STRING"
    position = F.unix_micros("at")
    for seed in range(3):
        rnd = random.Random(seed)
        start = datetime.datetime(2020, 1, 1)
        rows = [(f"k{rnd.randrange(3)}", start + datetime.timedelta(days=rnd.randrange(12)), n, rnd.choice(["a", "b", None]), f"n{n}")
                for n in range(40)]
        stored = None
        for part in range(4):
            batch = spark.createDataFrame(rows[part::4], schema)
            records = batch if stored is None else stored.select(*batch.columns).unionByName(batch)
            folded = history.versions_and_absorbed(records, ["id"], order, tracked, position)
            stored = spark.createDataFrame(folded.collect(), folded.schema)
        whole = history.versions(spark.createDataFrame(rows, schema), ["id"], order, tracked, position)
        got = stored.where(F.col("kind") == history.VERSION).drop("kind")
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
        assert stored.count() == 40


def test_client_history_merges_without_the_log(lake, monkeypatch):  # noqa: F811
    scores = iter(["700", "700", "710", "700", "700"])
    for n, score in enumerate(scores):
        lake.land_clients(f"daily/date_partition=2017-01-0{n + 1}/a", [("1", score), (f"x{n}", "1")])
        if n == 2:
            lake.clients.compact()
    state = lake.clients.table.state()
    last = lake.clients.last_batch()
    fresh = lake.clients._fresh(state, last, -1)
    assert log_batches(fresh) == {"3", "4"}  # the rest comes from the table's buckets
    lake.clients.compact()
    got = lake.clients.read().where("id = '1'").orderBy("valid_from").collect()
    assert [(r.credit_score, str(r.valid_from_date), r.is_current) for r in got] == [
        (700, "2017-01-01", False), (710, "2017-01-03", False), (700, "2017-01-04", True)]
    assert [r.valid_to for r in got] == [got[1].valid_from, got[2].valid_from, None]
    whole = history.versions(lake.clients._judged("valid", last).drop("reason"), ["id"], silver.ORDER,
                             silver.CLIENTS.tracked, F.unix_micros("ingested_at"))
    assert whole.count() == lake.clients.read().count()


def test_rows_that_waited_for_their_card_are_released_once(lake):  # noqa: F811
    lake.land_cards("c1", ["2"])
    rows = [tx(1), tx(2, card_id="9"), tx(3, card_id="9", use_chip="?"), tx(4, card_id="8"), tx(2, card_id="9"), tx(5, card_id="9", amount=None)]
    lake.land_tx("t1", rows)
    lake.transactions.compact()
    assert lake.requeue("nothing new") == 0
    lake.land_cards("c2", ["9"])
    assert lake.requeue("r") == 4 - 1  # two copies of 2, and 3; 5 failed for its amount before its card was looked at
    assert lake.requeue("again") == 0
    assert {r.id for r in lake.transactions.read().collect()} == {"1", "2"}
    assert sorted((r.id, r.reason) for r in lake.transactions.quarantine().collect()) == [
        ("3", "use_chip_invalid"), ("4", "card_unknown"), ("5", "amount_null")]
    # a later delivery of the same key wins over the released one, before and after merging
    lake.land_tx("t2", [tx(2, card_id="9", amount="$3.00")])
    for _ in range(2):
        assert {r.id: float(r.amount) for r in lake.transactions.read().collect()} == {"1": 77.0, "2": 3.0}
        lake.transactions.compact()
    lake.land_cards("c3", ["8"])
    assert lake.requeue("r2") == 1 and lake.transactions.compact(after_batches=50)
    assert {r.id for r in lake.transactions.read().collect()} == {"1", "2", "4"}


@pytest.mark.parametrize("die", [False, True])
def test_a_repeated_batch_meets_the_cards_of_its_first_attempt(spark, root, monkeypatch, die):
    """Cards change, and are merged, between a failure and the retry: table, quarantine and counters are as without it."""
    lake = Landed(spark, f"{root}/{die}")  # noqa: F811
    lake.land_cards("c1", ["2"])
    lake.cards.compact()
    put_json(f"{lake.landing('transactions')}/t.json", [tx(1), tx(2, card_id="9")])
    lake.ingest("transactions")
    if die:
        def lost(*_):
            raise RuntimeError("lost")
        with monkeypatch.context() as m:
            m.setattr(expectations, "observed_counts", lost)
            with pytest.raises(Exception):
                lake.apply("transactions", "t")
        lake.land_cards("c2", ["9"])
        lake.cards.compact()
    lake.apply("transactions", "t")
    assert [r.id for r in lake.transactions.read().collect()] == ["1"]
    assert [(r.id, r.reason) for r in lake.transactions.quarantine().collect()] == [("2", "card_unknown")]
    assert {r.rule: r.failed for r in lake.transactions.counters.read().collect()}["card_exists"] == 1
    if die:
        assert lake.requeue("r") == 1 and {r.id for r in lake.transactions.read().collect()} == {"1", "2"}
