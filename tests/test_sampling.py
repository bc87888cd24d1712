from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerline.operators import deliveries, profile, sampling


def days(spark, sizes):
    start = date(2017, 1, 1)
    rows = [(n * 1_000_000 + i, start + timedelta(days=n)) for n, size in enumerate(sizes) for i in range(size)]
    return spark.createDataFrame(rows, "id BIGINT, day DATE")


def test_exact_number_per_day_half_to_even(spark):
    sizes = [3989, 325, 375, 1, 20000, 24, 26]
    got = sampling.exact_rate(days(spark, sizes), "day", "id", 0.02, "A").groupBy("day").count().collect()
    counts = {(r.day - date(2017, 1, 1)).days: r["count"] for r in got}
    assert counts == {n: round(s * 0.02) for n, s in enumerate(sizes) if round(s * 0.02)}


def test_first_day_of_the_increment(spark):
    """3,989 source rows, 2 % late, 0.5 % of the rest copied: 3,929 rows in the file."""
    late = sampling.exact_rate(days(spark, [3989]), "day", "id", 0.02, "late")
    on_time = days(spark, [3989]).join(late, "id", "left_anti")
    copies = sampling.exact_rate(on_time, "day", "id", 0.005, "copy")
    assert on_time.count() + copies.count() == 3929


def test_same_rows_in_any_order_and_partitioning(spark):
    df = days(spark, [800, 50, 1300])
    a = sampling.exact_rate(df, "day", "id", 0.1, "s")
    b = sampling.exact_rate(df.orderBy(F.rand()).repartition(7), "day", "id", 0.1, "s")
    other = sampling.exact_rate(df, "day", "id", 0.1, "t")
    ids = [sorted(r.id for r in x.collect()) for x in (a, b, other)]
    assert ids[0] == ids[1] != ids[2]


def test_rates_zero_and_one(spark):
    df = days(spark, [10, 7])
    assert sampling.exact_rate(df, "day", "id", 0.0, "s").count() == 0
    assert sampling.exact_rate(df, "day", "id", 1.0, "s").count() == 17


def test_weights(spark):
    weights = [("train", 80), ("tune", 15), ("test", 5)]
    df = spark.range(20000).select(sampling.weighted("x", weights, F.col("id")).alias("g")).groupBy("g").count()
    share = {r.g: r["count"] / 200 for r in df.collect()}
    assert all(abs(share[g] - w) < 1.5 for g, w in weights)


def test_rows_without_a_day_are_a_day_of_their_own(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 2 == 0, F.lit("2017-01-01").cast("date")).alias("day"))
    got = sampling.exact_rate(df, "day", "id", 0.1, "s").groupBy("day").count().collect()
    assert [r["count"] for r in got] == [50, 50]


def test_device_type(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 2 == 0, "Online Transaction").otherwise("Chip Transaction").alias("use_chip"), "id")
    got = df.select("use_chip", sampling.device_type(F.col("use_chip"), F.col("id")).alias("d")).distinct().collect()
    assert {tuple(r) for r in got} == {
        ("Online Transaction", "mobile"), ("Online Transaction", "web"), ("Chip Transaction", "pos")}


def test_pseudonyms_are_stable_and_unique(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("name"))
    a = sampling.pseudonyms(df, "id", "k1")
    assert a.select("email").distinct().count() == a.select("name").distinct().count() == 5000
    assert sorted(a.collect(), key=str) == sorted(sampling.pseudonyms(df.repartition(5), "id", "k1").collect(), key=str)
    assert a.join(sampling.pseudonyms(df, "id", "k2"), "name").count() == 0


def deliveries_of(spark, rows):
    d = date(2017, 1, 1)
    return spark.createDataFrame(
        [(i, d + timedelta(days=e), d + timedelta(days=v), f"f{v}") for i, e, v in rows],
        "id STRING, event_date DATE, delivery_date DATE, source_file STRING")


def test_classification(spark):
    rows = deliveries_of(spark, [
        ("a", 0, 0), ("a", 0, 0),            # copy in the same file
        ("b", 0, 0), ("b", 0, 3),            # re-sent
        ("c", 0, 5),                         # late
        ("d", 0, 0), ("d", 0, 9),            # beyond the reach: not a re-send
        ("e", 0, 0), ("e", 0, 6), ("e", 0, 12),
    ])
    got = {(r.id, r.delivery_date.day): r for r in deliveries.classify(rows, {}).collect()}
    assert got["a", 1].in_file_duplicate and got["a", 1].n_copies == 2
    assert got["b", 4].is_resent and got["b", 4].days_late == 0
    assert got["c", 6].is_late and got["c", 6].days_late == 5
    assert not got["d", 10].is_resent and got["d", 10].days_late == 9
    assert got["e", 7].is_resent and got["e", 13].is_resent
    assert {r.id for r in deliveries.resent(rows).collect()} == {"b", "e"}
    kept = {r.n_deliveries: r.n_ids for r in deliveries.conservation(rows).collect()}
    assert kept == {1: 4, 2: 1}


def test_late_rows_move_between_days(spark):
    rows = deliveries_of(spark, [("a", 0, 0), ("b", 0, 2), ("c", 2, 2), ("d", 1, 2)])
    got = {r.day.day: (r.n_on_time, r.n_left_late, r.n_arrived_late, r.n_delivered)
           for r in deliveries.late_movement(rows).collect()}
    assert got == {1: (1, 1, 0, 1), 2: (0, 1, 0, 0), 3: (1, 0, 2, 3)}


def test_reconcile_counts_distinct_ids(spark):
    want = spark.createDataFrame([("n", "1"), ("n", "2"), ("n", "2")], "kind STRING, id STRING")
    have = spark.createDataFrame([("n", "2"), ("n", "2"), ("n", "3"), ("m", "9")], "kind STRING, id STRING")
    got = {r.kind: tuple(r)[1:] for r in deliveries.reconcile(want, have).collect()}
    assert got == {"n": (2, 2, 1, 1), "m": (0, 1, 0, 1)}


def test_day_guard():
    import pytest

    assert profile.check_day("2017-01-01") == "2017-01-01"
    for bad in ("2016-12-31", "2019-11-01", "not a day"):
        with pytest.raises(ValueError):
            profile.check_day(bad)
