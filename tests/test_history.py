import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import history
from ledgerline.operators.groups import GroupLimit, OrderedGroups

T0 = datetime(2020, 1, 1)
TIGHT = GroupLimit(rows=10)
JOINED = GroupLimit(rows=10, broadcast=0)


def log(spark, rows):
    return spark.createDataFrame(rows, "id STRING, at TIMESTAMP_NTZ, n INT, state STRING, note STRING")


def folded(df, limit=GroupLimit()):
    return history.versions(df, ["id"], ["at", "n"], ["state"], history.position(F.col("at"), "ntz"), limit=limit)


def skewed(seed, n=600, hot=0.5, burst=False):
    """Random change log; one key holds ``hot`` of the rows, in one burst if asked."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < hot else f"k{rnd.randrange(12)}"
        minutes = rnd.randrange(30) if burst and rnd.random() < 0.9 else rnd.randrange(60 * 24 * 40)
        at = T0 + timedelta(minutes=minutes) if rnd.random() < 0.97 else None  # no time: before all others
        rows.append((key, at, i, rnd.choice(["A", "B", None]), f"note{i}"))
    return rows


def brute_versions(rows):
    out = []
    for key in {r[0] for r in rows}:
        mine, last, opened = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] or datetime.min, r[2])), object(), []
        for r in mine:
            if r[3] != last:
                opened.append(r)
            last = r[3]
        for i, r in enumerate(opened):
            out.append((*r[:4], r[1], opened[i + 1][1] if i + 1 < len(opened) else None, i + 1 == len(opened)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [GroupLimit(), TIGHT, JOINED, GroupLimit(rows=1)])
@pytest.mark.parametrize("burst", [False, True])
def test_versions_equal_brute_force_whether_split_or_not(spark, limit, burst):
    rows = skewed(7, burst=burst)
    got = folded(log(spark, rows), limit).select("id", "at", "n", "state", "valid_from", "valid_to", "is_current")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_versions(rows)


def test_hot_keys_are_split(spark):
    groups = OrderedGroups(log(spark, skewed(3)), ["id"], ["at", "n"], history.position(F.col("at"), "ntz"), TIGHT)
    by_segment = groups.rows.where("id = 'hot'").groupBy("_parts", "_seg").count().collect()
    assert len(by_segment) > 10
    assert max(r["count"] for r in by_segment) <= 2 * TIGHT.rows + 10  # those without a time stay together


def test_segments_follow_the_rows_of_a_bursty_key(spark):
    """One old row and a burst of recent ones, each a second apart."""
    rows = [("hot", T0, 0, "A", "")] + [("hot", T0 + timedelta(days=900, seconds=i), i, "A", "") for i in range(1000)]
    groups = OrderedGroups(log(spark, rows), ["id"], ["at", "n"], history.position(F.col("at"), "ntz"), GroupLimit(rows=100))
    sizes = [r["count"] for r in groups.rows.groupBy("_seg").count().collect()]
    assert len(sizes) == 11 and max(sizes) <= 200


def test_every_hot_key_is_split(spark):
    rows = [(f"k{k}", T0 + timedelta(minutes=i), i, "A", "") for k in range(40) for i in range(25)]
    groups = OrderedGroups(log(spark, rows), ["id"], ["at", "n"], history.position(F.col("at"), "ntz"), TIGHT)
    assert max(r["count"] for r in groups.rows.groupBy("id", "_seg").count().collect()) <= 2 * TIGHT.rows


def test_a_b_a_is_three_versions_and_a_redelivery_none(spark):
    rows = [("1", T0 + timedelta(days=d), d, s, f"file{d}") for d, s in enumerate("ABAA")]
    got = folded(log(spark, rows)).orderBy("valid_from").collect()
    assert [r.state for r in got] == ["A", "B", "A"]
    assert [r.is_current for r in got] == [False, False, True]
    assert [r.valid_to for r in got] == [r.valid_from for r in got[1:]] + [None]
    assert got[2].note == "file2"  # lineage of the record that opened the version


def test_untracked_columns_open_no_version(spark):
    rows = [("1", T0 + timedelta(days=d), d, "A", f"n{d}") for d in range(5)]
    assert folded(log(spark, rows)).count() == 1


def test_same_time_is_ordered_by_the_tie_break(spark):
    rows = [("1", T0, n, s, "") for n, s in enumerate("ABB")]
    got = folded(log(spark, rows)).orderBy("n").collect()
    assert [(r.state, r.is_current) for r in got] == [("A", False), ("B", True)]


def test_current_versions_equal_the_latest_rows(spark):
    df = log(spark, skewed(11))
    current = folded(df).where("is_current").select("id", "state")
    newest = history.latest(df, ["id"], ["at", "n"]).select("id", "state")
    assert sorted(map(tuple, current.collect()), key=str) == sorted(map(tuple, newest.collect()), key=str)


def test_latest_ignores_input_order(spark):
    rows = skewed(5)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    a = history.latest(log(spark, rows), ["id"], ["at", "n"]).collect()
    b = history.latest(log(spark, shuffled).repartition(7), ["id"], ["at", "n"]).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_state_as_of(spark):
    rows = [("1", T0, 0, "A", ""), ("1", T0 + timedelta(days=2), 1, "B", ""), ("2", T0 + timedelta(days=5), 0, "C", "")]
    df = log(spark, rows)

    def at(d):
        day = F.lit((T0 + timedelta(days=d)).isoformat(sep=" ")).cast("timestamp_ntz")
        got = history.state_as_of(df, ["id"], ["at", "n"], F.col("at"), day)
        return {r.id: (r.state, r.changed_today) for r in got.collect()}

    assert at(0) == {"1": ("A", True)}
    assert at(1) == {"1": ("A", False)}
    assert at(2) == {"1": ("B", True)}
    assert at(9) == {"1": ("B", False), "2": ("C", False)}


@pytest.mark.parametrize("count_facts", [False, True])
@pytest.mark.parametrize("limit", [GroupLimit(), TIGHT, JOINED, GroupLimit(rows=1)])
def test_as_of_join_equals_brute_force(spark, limit, count_facts):
    rnd = random.Random(2)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    dims = [(rnd.choice(keys + ["d"]), T0 + timedelta(minutes=rnd.randrange(20000)), i, f"v{i}") for i in range(80)]
    facts = [(rnd.choice(keys + [None]), T0 + timedelta(minutes=rnd.randrange(20000)), i) for i in range(400)]
    facts += [(k, None, 2000 + i) for i, k in enumerate(keys)]  # no time: no version is in force
    facts += [(d[0], d[1], 1000 + d[2]) for d in dims[:10]]  # exactly at the start of a version
    d = spark.createDataFrame(dims, "id STRING, start TIMESTAMP_NTZ, n INT, version STRING")
    f = spark.createDataFrame(facts, "id STRING, ts TIMESTAMP_NTZ, fact INT")
    # counting a part of the facts only moves the cuts: rows beyond its range fall in the outer segments
    counted = f.where("fact < 200").select("id", F.col("ts").alias("_at")) if count_facts else None
    got = history.as_of_join(
        f, d, ["id"], "ts", "start", ["n"], ["version"], history.position(F.col("_at"), "ntz"), limit, counted)

    def found(key, ts):
        known = [x for x in dims if x[0] == key and ts and x[1] <= ts]
        return max(known, key=lambda x: (x[1], x[2]))[3] if known else None

    assert got.columns == ["id", "ts", "fact", "version"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        ((key, ts, n, found(key, ts)) for key, ts, n in facts), key=str)


def test_position_of_a_wall_clock_time_ignores_the_zone(spark):
    df = spark.createDataFrame([(datetime(2019, 3, 10, h, 30),) for h in range(5)], "at TIMESTAMP_NTZ")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r[0] for r in df.select(history.position(F.col("at"), "ntz")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [b - a for a, b in zip(got, got[1:])] == [3600] * 4


def test_state_of_sparse_records(spark):
    """Every column has its own last value; nulls change nothing, in any column."""
    rows = [("a", 1, "x", None), ("a", 2, None, 5), ("a", 3, None, None), ("a", 4, "late", 9), ("b", 3, None, None), ("c", 4, "y", 1)]
    df = spark.createDataFrame(rows, "id STRING, day INT, s STRING, n INT")
    got = history.state_as_of_sparse(df, ["id"], ["day"], ["s", "n"], F.col("day"), F.lit(3))
    assert sorted(map(tuple, got.collect())) == [("a", "x", 5, True), ("b", None, None, True)]


def test_parts_that_are_not_the_whole_are_caught(spark):
    from ledgerline.operators import profile

    whole = spark.range(100).select("id", F.lit("v").alias("v"))
    first, second = whole.where("id < 40"), whole.where("id >= 40")
    assert profile.parts_report(whole, first, second).first().is_complete
    one_lost_one_doubled = second.where("id <> 50").unionByName(second.where("id = 60"))
    for parts in ((first, one_lost_one_doubled), (first, second.where("id <> 50")), (first, second.unionByName(first.limit(1)))):
        assert not profile.parts_report(whole, *parts).first().is_complete
    lost = profile.parts_report(whole, first, one_lost_one_doubled).first()
    assert lost.n_total == lost.n_before + lost.n_after
