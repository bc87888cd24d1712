"""Large JSON objects read in parallel, whatever text is in them; places in a sorted table."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import profile
from ledgerline.sources import snapshots


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def odd_text(rnd):
    return "".join(rnd.choice([",", '"', "\\", ":", "{", "}", "a", "é", "🙂", " ", "\n", '","', '": "', "\\\"", "}}", "x" * 50])
                   for _ in range(rnd.randrange(12)))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("indent", [None, 1])
def test_any_text_over_many_blocks(spark, root, small_blocks, seed, indent):
    rnd = random.Random(seed)
    files = []
    for name in ("a", "b"):
        odd = rnd.choice([0.05, 0.5, 1.0])
        entries = {f"{odd_text(rnd)}#{n}" if rnd.random() < odd else str(n): odd_text(rnd) if rnd.random() < odd else "Yes"
                   for n in range(400)}
        files.append(entries)
        path = f"{root}/{name}.json"
        spark.sparkContext._jvm.java.io.File(root).mkdirs()
        with open(path, "w") as f:
            json.dump({"target": entries}, f, indent=indent, ensure_ascii=rnd.random() < 0.5)
    df = snapshots.read_labels_map(spark, root)
    assert spark.read.option("lineSep", ",").text(root).rdd.getNumPartitions() > 4
    got = sorted((r.source_file[-6], r.transaction_id, r.is_fraud) for r in df.collect())
    assert got == sorted(("ab"[i], k, v) for i, entries in enumerate(files) for k, v in entries.items())


@pytest.mark.parametrize("text, rows", [("{}", []), ('{"target": {}}', []), ('{"target": {"a": null, "b": 5}}', [("a", None), ("b", "5")])])
def test_empty_objects_and_values_that_are_no_texts(spark, root, text, rows):
    spark.sparkContext._jvm.java.io.File(root).mkdirs()
    with open(f"{root}/x.json", "w") as f:
        f.write(text)
    got = snapshots.read_labels_map(spark, root) if "target" in text else snapshots.read_codes(spark, root)
    assert sorted(tuple(r)[:2] for r in got.collect()) == rows


@pytest.mark.parametrize("text", [
    '{"1": "Yes", "x": {"2": "No"}}', '{"target": {"1": "Yes"}, "other": "No"}', '{"target": {"1": "Yes" "2"}}',
    '{"target": {"1": "Yes",}}', '{"target": {"1": {"a": "b"}}}', '{"target": {"1": [1, 2]}}', 'nothing'])
def test_what_is_no_flat_object_stops_the_job(spark, root, text):
    spark.sparkContext._jvm.java.io.File(root).mkdirs()
    with open(f"{root}/x.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="not a label pair"):
        snapshots.read_labels_map(spark, root).count()


def test_plain_pairs_are_not_shuffled(spark, root):
    spark.sparkContext._jvm.java.io.File(root).mkdirs()
    with open(f"{root}/x.json", "w") as f:
        json.dump({str(n): "Yes" for n in range(1000)}, f)
    df = snapshots.read_codes(spark, root)
    assert df.count() == 1000
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Union") < text.index("RLIKE" if "RLIKE" in text else "rlike")


def test_places_over_many_ranges(spark, root):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000, numPartitions=8).select(((F.col("id") * 7919) % 5000).cast("string").alias("id"))
        got = profile.placed(profile.numeric_order(df, "id").select("id"), root)
        rows = {r.id: r.place for r in got.collect()}
        files = spark.read.parquet(root).select(F.input_file_name()).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert rows == {str(n): n + 1 for n in range(5000)} and files > 1
