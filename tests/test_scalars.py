from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions import scalars as s
from ledgerline.operators import conform
from ledgerline import contracts as k


def run(spark, fn, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n INT, v STRING")
    return [r.x for r in df.select("n", fn(F.col("v")).alias("x")).orderBy("n").collect()]


def test_money(spark):
    texts = ["$77.00", "$-5.00", "$5.005", "abc", "", None, "$99999999999.00", "$29278", "1$2$3", "-$4"]
    assert run(spark, s.money, texts) == [
        Decimal("77.00"), Decimal("-5.00"), Decimal("5.01"), None, None, None, None,
        Decimal("29278.00"), Decimal("123.00"), Decimal("-4.00"),
    ]


def test_zip(spark):
    assert run(spark, s.zip5, ["523.0", "58523.0", "1234567.0", "7", None]) == [
        "00523", "58523", "12345", "00007", None]


def test_errors(spark):
    assert run(spark, s.error_list, [None, "Bad PIN", "Bad PIN,Insufficient Balance"]) == [
        None, ["Bad PIN"], ["Bad PIN", "Insufficient Balance"]]


def test_yes_no(spark):
    texts = ["Yes", "NO", "yes", "no", "YES", "maybe", None, ""]
    assert run(spark, s.yes_no, texts) == [True, False, True, False, True, None, None, None]


def test_months(spark):
    assert run(spark, s.month_end, ["02/2020", "13/2020", "12/2021", None, "soon"]) == [
        date(2020, 2, 29), None, date(2021, 12, 31), None, None]
    assert run(spark, s.month_start, ["02/2020", "00/2020"]) == [date(2020, 2, 1), None]


def test_birth_date_out_of_range_is_null(spark):
    df = spark.createDataFrame(
        [("1970", "5"), ("1970", "13"), ("1970", "0"), ("x", "1"), (None, "1"), ("0", "1")], "y STRING, m STRING")
    got = [r.x for r in df.select(s.first_of_month(F.col("y"), F.col("m")).alias("x")).collect()]
    assert got == [date(1970, 5, 1), None, None, None, None, None]


def test_event_time_keeps_the_wall_clock_in_any_zone(spark):
    texts = ["2010-01-01 00:01:00", "2019-03-10T02:30:00", "not-a-date", None]
    want = [datetime(2010, 1, 1, 0, 1), datetime(2019, 3, 10, 2, 30), None, None]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert run(spark, s.event_time, texts) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_delivery_date(spark):
    assert run(spark, s.delivery_date, ["/x/daily/date_partition=2017-01-02/p.csv", "/x/backfill/p.csv"]) == [
        date(2017, 1, 2), None]


def test_broken_merchant_gives_nulls(spark):
    row = {"id": "1", "date": "2010-01-01 00:00:00", "client_id": "1", "card_id": "1", "amount": "$1",
           "use_chip": "Chip Transaction", "errors": None, "merchant": "{broken"}
    df = spark.createDataFrame([row], ", ".join(f"{c} STRING" for c in row))
    got = conform.transactions(df).first()
    assert got.merchant_id is None and got.amount == Decimal("1.00")


def test_card_number_must_be_truncated_first(spark):
    import pytest

    raw = spark.createDataFrame([tuple("x" for _ in k.CARD_COLUMNS)], ", ".join(f"{c} STRING" for c in k.CARD_COLUMNS))
    with pytest.raises(ValueError):
        conform.cards(raw)
    cut = conform.truncate_pan(raw.withColumn("card_number", F.lit("4111222233334444")))
    row = cut.first().asDict()
    assert (row["card_bin"], row["card_last4"]) == ("411122", "4444")
    assert not {"cvv", "card_number"} & set(row)
