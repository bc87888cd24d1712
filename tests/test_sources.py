import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import lookups, profile
from ledgerline.sources import files, snapshots
from ledgerline.sources.versions import ReplacedTable
from ledgerline.streaming import silver


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_explicit_inferred_and_plain(spark, root):
    path = put(f"{root}/users.csv", "id,yearly_income\n1,$29278\n2,$5\n")
    typed = files.read_csv(spark, path, ["id", "yearly_income"])
    assert [f.dataType.simpleString() for f in typed.schema] == ["string", "string"]
    guessed = files.read_csv(spark, path, infer=True)
    assert [f.dataType.simpleString() for f in guessed.schema] == ["int", "string"]
    plain = files.read_csv(spark, path)
    assert plain.columns == ["id", "yearly_income"] and plain.first().id == "1"


def test_partitioned_json_is_discovered(spark, root):
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2 + 2010).alias("year"))
    files.write_partitioned(df, root, "year", "json")
    back = files.read_json(spark, root)
    assert {r.year: r["count"] for r in back.groupBy("year").count().collect()} == {2010: 5, 2011: 5}
    assert len(glob.glob(f"{root}/year=2010/*.json")) == 1


def test_mixed_layouts_need_the_recursive_scan(spark, root):
    put(f"{root}/backfill/year=2010/a.json", '{"id":"1"}\n')
    put(f"{root}/daily/date_partition=2017-01-01/b.json", '{"id":"2","device_type":"pos"}\n')
    got = files.read_json(spark, root, "id STRING, device_type STRING", recursive=True)
    assert sorted(map(tuple, got.collect())) == [("1", None), ("2", "pos")]


def test_day_rerun_replaces_only_that_day(spark, root):
    def day(d, n):
        return spark.range(n).select("id", F.lit(d).alias("date_partition"))

    for d, n in (("2017-01-01", 5), ("2017-01-02", 7), ("2017-01-03", 9), ("2017-01-01", 5)):
        files.write_json_days(day(d, n), root)
    got = {str(r.date_partition): r["count"] for r in files.read_json(spark, root).groupBy("date_partition").count().collect()}
    assert got == {"2017-01-01": 5, "2017-01-02": 7, "2017-01-03": 9}


def test_null_fields_are_written(spark, root):
    df = spark.createDataFrame([("1", None, "d")], "id STRING, amount STRING, date_partition STRING")
    files.write_json_days(df, root)
    text = open(glob.glob(f"{root}/date_partition=d/*.json")[0]).read()
    assert json.loads(text) == {"id": "1", "amount": None}


def test_csv_days_and_small_csv(spark, root):
    df = spark.range(20).select(F.col("id").cast("string").alias("id"), F.lit("2017-01-01").alias("date_partition"))
    files.write_csv_days(df, f"{root}/days")
    files.write_small_csv(df, f"{root}/one")
    assert files.read_csv(spark, f"{root}/days").count() == 20
    assert len(glob.glob(f"{root}/one/*.csv")) == 1


def test_parent_folder_and_stats(spark, root):
    spark.range(30).select("id", (F.col("id") % 3).alias("m")).write.partitionBy("m").parquet(f"{root}/prepared")
    parent = spark.read.parquet(f"{root}/prepared")
    assert parent.count() == 30
    stats = files.file_stats(parent).first()
    on_disk = glob.glob(f"{root}/prepared/*/*.parquet")
    assert (stats.n_files, stats.n_rows) == (len(on_disk), 30)
    assert stats.n_bytes == sum(os.path.getsize(p) for p in on_disk)


CODES = {"5812": "Eating Places, Restaurants", "5411": "Grocery \"Stores\"", "1": "a: b, {c}"}


def test_codes_by_map_and_by_unpivot(spark, root):
    path = put(f"{root}/codes.json", json.dumps(CODES, indent=2))
    by_map = snapshots.read_codes(spark, path)
    assert {r.mcc: r.description for r in by_map.collect()} == CODES
    assert by_map.columns == ["mcc", "description", "source_file", "ingested_at"]
    wide = snapshots.read_wide_object(spark, path)
    assert {r.mcc: r.description for r in wide.collect()} == CODES


@pytest.mark.parametrize("indent", [None, 2])
def test_labels_whole_and_split(spark, root, indent):
    want = {str(n): "Yes" if n % 7 == 0 else "No" for n in range(5000)}
    path = put(f"{root}/labels.json", json.dumps({"target": want}, indent=indent))
    for read in (snapshots.read_labels_map, snapshots.read_labels):
        assert {r.transaction_id: r.is_fraud for r in read(spark, path).collect()} == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        split = snapshots.read_labels(spark, path)
        assert split.rdd.getNumPartitions() > 4
        assert {r.transaction_id: r.is_fraud for r in split.collect()} == want
        assert split.count() == len(want)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", [
    '{"target": {"1": "Yes", "2": 3}}', '{"target": {"1": "Yes", "a,b": "No"}}', '{"1": "Yes", "x": {"2": "No"}}',
    '{"target": {"1": "Yes"}, "other": "No"}', r'{"target": {"1\u0041": "Yes"}}', '{"target": {"1": null}}',
    '{"target": {"1": "Yes" "2"}}', '{"target": {"1": "Yes",}}'])
def test_split_reader_refuses_what_it_cannot_read(spark, root, text):
    path = put(f"{root}/labels.json", text)
    with pytest.raises(Exception, match="not a label pair"):
        snapshots.read_labels(spark, path).count()


def test_odd_values_by_the_map_reader(spark, root):
    path = put(f"{root}/labels.json", r'{"target": {"1": null, "2": 3, "a\u0041\"": "x,y", "4": "No"}}')
    got = {r.transaction_id: r.is_fraud for r in snapshots.read_labels_map(spark, path).collect()}
    assert got == {"1": None, "2": "3", 'aA"': "x,y", "4": "No"}


def test_empty_label_object(spark, root):
    path = put(f"{root}/labels.json", '{"target": {}}')
    assert snapshots.read_labels(spark, path).count() == 0


def test_versions_are_switched_whole(spark, root):
    table = ReplacedTable(spark, root)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.publish(spark.range(5), upto=3)
    first = table.read()
    assert table.publish(table.read().where("id > 1"), upto=4) == 2
    assert (first.count(), table.read().count(), table.latest().upto) == (5, 3, 4)
    table.publish(spark.range(9))
    assert table.read().count() == 9
    assert len(os.listdir(f"{root}/data")) == 2  # the one before stays for its readers, older ones go


def test_unfinished_version_is_not_seen(spark, root, monkeypatch):
    table = ReplacedTable(spark, root)
    table.publish(spark.range(5))

    def die(*_):
        raise RuntimeError("lost before the announcement")

    with monkeypatch.context() as m:
        m.setattr(ReplacedTable, "_announce", die)
        with pytest.raises(RuntimeError):
            table.publish(spark.range(99))
    assert table.read().count() == 5
    table.publish(spark.range(7))
    assert table.read().count() == 7


def test_two_writers_of_one_version(spark, root, monkeypatch):
    table, other = ReplacedTable(spark, root), ReplacedTable(spark, root)
    table.publish(spark.range(5))
    stale = other.latest()
    table.publish(spark.range(6))
    monkeypatch.setattr(other, "latest", lambda: stale)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        other.publish(spark.range(99))
    assert table.read().count() == 6


def test_snapshot_rules(spark, root):
    raw = spark.createDataFrame([("1", "Yes"), ("2", "maybe"), (None, "No")], "transaction_id STRING, is_fraud STRING")
    target = silver.labels(spark, root)
    target.refresh(raw, "r")
    counts = {r.rule: (r.passed, r.failed) for r in target.counters.read().collect()}
    assert counts == {"transaction_id_present": (2, 1), "is_fraud_valid": (2, 1)}
    assert sorted(map(tuple, target.read().select("transaction_id", "is_fraud").collect())) == [("1", True), ("2", None)]


def test_layers(spark):
    names = files.create_layers(spark, "lake_test")
    assert {f"lake_test_{n}" for n in ("landing", "bronze", "silver", "gold", "ops")} == set(names)
    assert set(names) <= {d.name for d in spark.catalog.listDatabases()}
    assert files.create_layers(spark, "lake_test") == names
    for name in names:
        spark.sql(f"DROP DATABASE {name}")


def test_lookup_and_orphans(spark):
    cards = spark.createDataFrame([("1",), ("2",)], "id STRING")
    tx = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", None), ("d", "9")], "tx STRING, card_id STRING")
    got = {r.tx: r.card_exists for r in lookups.card_exists(tx, cards).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}
    lost = {r.orphan_key: r.n_rows for r in lookups.orphans(tx, "card_id", cards, "id").collect()}
    assert lost == {"9": 2, None: 1}


def test_profile(spark):
    df = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "id STRING")
    assert tuple(profile.key_profile(df, "id").first()) == (4, 2, 1, False)
    assert tuple(profile.key_profile(df.where("id = '1'"), "id").first()) == (1, 1, 0, True)
    assert tuple(profile.key_profile(df.where("id = 'x'"), "id").first()) == (0, 0, 0, True)
    order = [r.id for r in profile.numeric_order(
        spark.createDataFrame([("10",), ("9",), ("100",)], "id STRING"), "id").collect()]
    assert order == ["9", "10", "100"]


def test_coverage_with_many_rows_per_key(spark):
    facts = spark.createDataFrame([("1", "x")] * 50 + [("2", "x"), ("3", "y")], "id STRING, g STRING")
    labels = spark.createDataFrame([("1", True), ("3", False)], "t STRING, f BOOLEAN")
    got = {r.grp: tuple(r)[1:] for r in lookups.label_coverage(facts, "id", F.col("g"), labels, "t", "f").collect()}
    assert got == {"x": (51, 50, 50), "y": (1, 1, 0)}


def test_refund_pairs_are_matched_one_to_one(spark):
    rows = [("c", 5.0)] * 40 + [("c", -5.0)] * 30 + [("c", 7.0), ("d", -7.0), ("c", 0.0)]
    df = spark.createDataFrame(rows, "k STRING, amount DOUBLE")
    got = lookups.refund_pairs(df, ["k"]).collect()
    assert [(r.k, r.abs_amount, r.n_purchases, r.n_refunds, r.n_pairs) for r in got] == [("c", 5.0, 40, 30, 30)]
