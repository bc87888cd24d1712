"""Inputs of the registered queries: the given tables reshaped as deliveries of the five sources.

Every row of the table goes in. Defects and copies are added by fixed rules on the key, so their
number grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import conform, lookups
from ledgerline.operators.sampling import device_type

NEW_COLUMN_FROM = "2024-01-16"
DAY_PATH = "landing/transactions/daily/date_partition="


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(value: Column) -> Column:
    return value.cast("decimal(12,2)").cast("string")


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text deliveries of ``events``: each event once (seq 0), some twice in a file (seq 1), some re-sent (seq 2)."""
    e = F.col("event_id")
    event_date = F.col("ts").cast("date")
    deliveries = F.array_compact(F.array(
        F.lit(0), F.when(e % 200 == 11, F.lit(1)), F.when(e % 200 == 23, F.lit(2)),
    ))
    rows = table(spark, sf_dir, "events").drop("props").withColumn("seq", F.explode(deliveries))
    late = F.when(e % 50 == 3, (1 + e % 7).cast("int")).otherwise(0)
    lag = F.when(F.col("seq") == 2, 2).otherwise(0)
    text, kind = _cents(F.col("value")), F.col("event_type")
    use_chip = (
        F.when(kind.isin("click", "signup"), "Online Transaction")
        .when(kind == "view", "Swipe Transaction")
        .when(kind == "purchase", "Chip Transaction")
        .when(e % 10 == 0, F.lit(None).cast("string"))
        .when(e % 10 == 1, "Unknown")
        .otherwise("Swipe Transaction")
    )
    merchant = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("merchant_id"),
        F.concat(F.lit("City "), (F.col("user_id") % 10).cast("string")).alias("merchant_city"),
        F.when(e % 8 == 0, "Italy").otherwise("CA").alias("merchant_state"),
        F.when(e % 4 != 0, F.concat((500 + e).cast("string"), F.lit(".0"))).alias("zip"),
        (5000 + e % 25).cast("string").alias("mcc"),
    ), {"ignoreNullFields": "false"})
    return rows.select(
        "event_id", "seq",
        F.when(e % 2500 != 9, e.cast("string")).alias("id"),
        F.when(e % 1000 == 17, "not-a-date").otherwise(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("date"),
        F.col("user_id").cast("string").alias("client_id"),
        F.when(e % 333 == 5, (900000 + e).cast("string")).otherwise(
            F.col("user_id").cast("string")).alias("card_id"),
        F.when(e % 200 == 7, F.lit(None).cast("string"))
        .when(e % 500 == 3, "abc")
        .when(e % 20 == 1, F.concat(F.lit("$-"), text))
        .otherwise(F.concat(F.lit("$"), text)).alias("amount"),
        use_chip.alias("use_chip"),
        F.when(e % 50 == 0, "Bad PIN,Insufficient Balance").when(e % 50 == 1, "Bad PIN").alias("errors"),
        merchant.alias("merchant"),
        event_date.alias("event_date"),
        F.date_add(event_date, (lag + late).cast("int")).alias("delivery_date"),
    ).withColumns({
        "device_type": F.when(
            F.col("event_date") >= F.lit(NEW_COLUMN_FROM).cast("date"),
            device_type(F.col("use_chip"), F.col("event_id"))),
        "source_file": F.concat(F.lit(DAY_PATH), F.col("delivery_date").cast("string"), F.lit("/part.json")),
        "rescued_data": F.lit(None).cast("string"),
    })


def answer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kind, id`` of every defect that :func:`raw_transactions` puts into deliveries that have an id."""
    e = F.col("event_id")
    kinds = F.array_compact(F.array(
        F.when(e % 200 == 7, F.lit("null_amount")),
        F.when(e % 333 == 5, F.lit("unknown_card")),
        F.when(e % 200 == 11, F.lit("in_file_duplicate")),
        F.when(e % 200 == 23, F.lit("resent")),
        F.when(e % 50 == 3, F.lit("late")),
    ))
    return (
        table(spark, sf_dir, "events")
        .select(F.explode(kinds).alias("kind"), F.when(e % 2500 != 9, e.cast("string")).alias("id"))
        .where(F.col("id").isNotNull())
    )


RAW_KEYS = ["event_id", "seq"]
RAW_REPORT = RAW_KEYS + ["event_date", "delivery_date"]


def current_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key of the current cards: customers."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))


def typed_transactions(spark: SparkSession, sf_dir: str, extra: list[str] | None = None) -> DataFrame:
    typed = conform.transactions(raw_transactions(spark, sf_dir), extra or RAW_REPORT)
    return lookups.card_exists(typed, current_cards(spark, sf_dir))


def client_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of clients: orders by customer."""
    return table(spark, sf_dir, "orders")


def raw_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client records as text, one per customer."""
    n = F.col("c_custkey")
    cents = _cents(F.abs("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        n.cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.lit("000-00-0000").alias("ssn"),
        F.concat(F.lit("client"), n.cast("string"), F.lit("@example.com")).alias("email"),
        (18 + n % 70).cast("string").alias("current_age"),
        F.when(n % 101 == 0, "soon").otherwise((60 + n % 10).cast("string")).alias("retirement_age"),
        (1950 + n % 50).cast("string").alias("birth_year"),
        (1 + n % 13).cast("string").alias("birth_month"),
        F.when(n % 3 == 0, "Male").when(n % 3 == 1, "Female").when(n % 5 == 0, "X").alias("gender"),
        F.concat((100 + n % 900).cast("string"), F.lit(" "), F.col("c_mktsegment"), F.lit(" St, Apt 4")).alias("address"),
        F.concat((20 + n % 50).cast("string"), F.lit(".25")).alias("latitude"),
        F.concat(F.lit("-"), (70 + n % 50).cast("string"), F.lit(".5")).alias("longitude"),
        F.concat(F.lit("$"), cents).alias("per_capita_income"),
        F.concat(F.lit("$"), ((n % 1000) * 100).cast("string")).alias("yearly_income"),
        F.when(n % 97 == 0, "").otherwise(F.concat(F.lit("$-"), cents)).alias("total_debt"),
        (250 + n % 650).cast("string").alias("credit_score"),
        F.col("c_nationkey").cast("string").alias("num_credit_cards"),
    )


def client_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each client record delivered three times: first, unchanged, with another income."""
    days = F.array(*[F.lit(d).cast("timestamp_ntz") for d in CLIENT_DAYS])
    sent = raw_clients(spark, sf_dir).withColumn("delivered_at", F.explode(days))
    return sent.withColumn("yearly_income", F.when(
        F.col("delivered_at") == F.lit(CLIENT_DAYS[2]).cast("timestamp_ntz"), "$64200").otherwise(F.col("yearly_income")))


CLIENT_DAYS = ["2024-01-01 00:00:00", "2024-01-10 00:00:00", "2024-01-20 00:00:00"]


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card records as text, one per part, with card number and CVV."""
    return card_records(table(spark, sf_dir, "part"))


def card_records(parts: DataFrame) -> DataFrame:
    n = F.col("p_partkey")
    month = F.lpad((1 + n % 12).cast("string"), 2, "0")
    opened = F.concat(month, F.lit("/"), (1999 + n % 15).cast("string"))
    return parts.select(
        n.cast("string").alias("id"),
        (n % 1500).cast("string").alias("client_id"),
        F.col("p_brand").alias("card_brand"),
        F.when(n % 4 == 0, "Credit").when(n % 4 == 1, "Debit").when(n % 4 == 2, "Debit (Prepaid)")
        .otherwise(F.col("p_type")).alias("card_type"),
        F.concat(F.lit("4"), F.lpad(n.cast("string"), 15, "3")).alias("card_number"),
        F.when(n % 97 == 0, "13/2020").otherwise(
            F.concat(month, F.lit("/"), (2017 + n % 6).cast("string"))).alias("expires"),
        F.lpad((n % 1000).cast("string"), 3, "0").alias("cvv"),
        F.when(n % 2 == 0, "YES").otherwise("NO").alias("has_chip"),
        (1 + n % 3).cast("string").alias("num_cards_issued"),
        F.concat(F.lit("$"), _cents(F.col("p_retailprice"))).alias("credit_limit"),
        F.when(n % 89 == 0, "00/2001").otherwise(opened).alias("acct_open_date"),
        (2002 + n % 18).cast("string").alias("year_pin_last_changed"),
        F.when(n % 50 == 0, "Yes").when(n % 50 == 1, "maybe").otherwise("No").alias("card_on_dark_web"),
    )


def raw_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fraud labels as text, from the labelled documents."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("transaction_id"),
        F.when(F.col("toxic") == 1, "Yes").otherwise("No").alias("is_fraud"),
    )


def raw_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code dictionary objects as JSON text: two codes per part."""
    n = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(F.to_json(F.create_map(
        F.concat(F.lit("N"), n), F.col("p_name"), F.concat(F.lit("T"), n), F.col("p_type"),
    )).alias("value"))
