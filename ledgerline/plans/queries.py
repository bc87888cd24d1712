"""The registered queries. Each takes (spark, sf_dir) and returns a DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import contracts as k
from ledgerline.functions import scalars as s
from ledgerline.operators import (
    conform, deliveries, expectations, history, lookups, profile, sampling,
)
from ledgerline.operators.groups import GroupLimit
from ledgerline.plans import gold
from ledgerline.plans import inputs as i
from ledgerline.session import work_dir
from ledgerline.sources import drift, files, snapshots
from ledgerline.streaming import bronze, silver

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """A derived table written and read back, as Gold reads stored Silver tables."""
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _errors_text() -> F.Column:
    return F.array_join("errors", "|").alias("errors")


def _typed_text(df: DataFrame) -> DataFrame:
    """Arrays joined to text and lineage left out, for a flat result."""
    kept = [c for c in df.columns if c not in (k.RESCUED, *k.LINEAGE, "errors")]
    return df.select(*kept, *([_errors_text()] if "errors" in df.columns else []))


# --- typing ---------------------------------------------------------------------------------

@query
def typed_transactions(spark, sf_dir):
    return _typed_text(i.typed_transactions(spark, sf_dir))


@query
def money_parse(spark, sf_dir):
    amount = s.money(F.col("amount"))
    return i.raw_transactions(spark, sf_dir).select(
        *i.RAW_KEYS, amount.alias("amount"), (amount < 0).alias("is_refund"))


@query
def zip_normalize(spark, sf_dir):
    shop = s.merchant_struct(F.col("merchant"))
    return i.raw_transactions(spark, sf_dir).select(
        *i.RAW_KEYS, shop["zip"].alias("zip"), s.zip5(shop["zip"]).alias("merchant_zip"))


@query
def errors_split(spark, sf_dir):
    errors = s.error_list(F.col("errors"))
    return i.raw_transactions(spark, sf_dir).select(
        *i.RAW_KEYS, F.when(errors.isNotNull(), F.size(errors)).cast("bigint").alias("n_errors"),
        F.get(errors, F.lit(0)).alias("first_error"), F.get(errors, F.lit(1)).alias("second_error"))


@query
def json_path_extract(spark, sf_dir):
    raw = i.raw_transactions(spark, sf_dir).withColumn("shop", s.merchant_struct(F.col("merchant")))
    return raw.select(*i.RAW_KEYS, "shop.*")


@query
def nest_struct(spark, sf_dir):
    """Flat columns nested by the file contract, written as text and flattened again."""
    raw = i.raw_transactions(spark, sf_dir).withColumn("shop", s.merchant_struct(F.col("merchant")))
    flat = raw.select(*i.RAW_KEYS, *[c for c in k.TRANSACTION_COLUMNS if c != "merchant"], "shop.*")
    nested = conform.to_landing_transactions(flat, extra=i.RAW_KEYS)
    return nested.select(*i.RAW_KEYS, "id", "merchant.*")


@query
def typed_clients(spark, sf_dir):
    return _typed_text(conform.clients(i.raw_clients(spark, sf_dir)))


@query
def birth_date(spark, sf_dir):
    return i.raw_clients(spark, sf_dir).select(
        "id", s.first_of_month(F.col("birth_year"), F.col("birth_month")).alias("birth_date"))


@query
def typed_cards(spark, sf_dir):
    return _typed_text(conform.cards(conform.truncate_pan(i.raw_cards(spark, sf_dir))))


@query
def card_dates(spark, sf_dir):
    return i.raw_cards(spark, sf_dir).select(
        "id", s.month_end(F.col("expires")).alias("expires_on"),
        s.month_start(F.col("acct_open_date")).alias("opened_on"))


@query
def pan_truncate(spark, sf_dir):
    return conform.truncate_pan(i.raw_cards(spark, sf_dir))


@query
def typed_labels(spark, sf_dir):
    return _typed_text(conform.labels(i.raw_labels(spark, sf_dir)))


@query
def typed_codes(spark, sf_dir):
    pairs = i.raw_codes(spark, sf_dir).select(
        F.explode(F.from_json("value", "MAP<STRING, STRING>")).alias("mcc", "description"))
    return _typed_text(expectations.keep(conform.codes(pairs), k.CODE_RULES))


# --- joins ----------------------------------------------------------------------------------

@query
def card_lookup(spark, sf_dir):
    rows = i.raw_transactions(spark, sf_dir).select(*i.RAW_KEYS, "card_id")
    return lookups.card_exists(rows, i.current_cards(spark, sf_dir))


@query
def orphans_labels(spark, sf_dir):
    """Documents without a label."""
    return lookups.orphans(
        i.table(spark, sf_dir, "documents"), "doc_id", i.table(spark, sf_dir, "labels"), "doc_id")


@query
def orphans_lineitem(spark, sf_dir):
    """Lines whose order is not among the finished ones."""
    finished = i.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return lookups.orphans(i.table(spark, sf_dir, "lineitem"), "l_orderkey", finished, "o_orderkey")


@query
def orphans_events(spark, sf_dir):
    """Event users that are not customers of four of the five segments."""
    known = i.table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return lookups.orphans(i.table(spark, sf_dir, "events"), "user_id", known, "c_custkey")


@query
def orphans_label_transactions(spark, sf_dir):
    """Labels whose transaction is not among the current ones."""
    return lookups.orphans(
        i.raw_labels(spark, sf_dir), "transaction_id", scd1_transactions(spark, sf_dir), "id")


@query
def orphans_card_clients(spark, sf_dir):
    """Clients of cards that are missing from the male clients."""
    known = i.raw_clients(spark, sf_dir).where("gender = 'Male'")
    return lookups.orphans(i.raw_cards(spark, sf_dir), "client_id", known, "id")


@query
def orphans_cards(spark, sf_dir):
    """Card numbers of transactions that no current card has."""
    return lookups.orphans(
        i.raw_transactions(spark, sf_dir), "card_id", i.current_cards(spark, sf_dir), "id")


@query
def orphans_codes(spark, sf_dir):
    """Merchant categories of transactions that are missing from the dictionary."""
    tx = i.raw_transactions(spark, sf_dir).select(s.merchant_struct(F.col("merchant"))["mcc"].alias("mcc"))
    known = i.table(spark, sf_dir, "part").select((F.col("p_partkey") + 5003).cast("string").alias("mcc"))
    return lookups.orphans(tx, "mcc", known, "mcc")


@query
def enrich_left(spark, sf_dir):
    nation = i.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookups.enrich(i.table(spark, sf_dir, "customer"), nation, "c_nationkey")


@query
def label_tristate(spark, sf_dir):
    docs = i.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    labels = conform.labels(i.raw_labels(spark, sf_dir)).select(
        F.col("transaction_id").alias("id"), F.col("is_fraud").alias("fraud_flag"))
    return lookups.enrich(docs, labels, "id")


@query
def label_coverage(spark, sf_dir):
    labels = conform.labels(i.raw_labels(spark, sf_dir))
    docs = i.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), "lang")
    return lookups.label_coverage(docs, "id", F.col("lang"), labels, "transaction_id", "is_fraud")


@query
def label_coverage_by_year(spark, sf_dir):
    """Transactions and how many of them are labelled, per year of the transaction."""
    labels = conform.labels(i.raw_labels(spark, sf_dir))
    tx = i.raw_transactions(spark, sf_dir).select("id", F.substring("date", 1, 4).alias("year"))
    return lookups.label_coverage(tx, "id", F.col("year"), labels, "transaction_id", "is_fraud")


@query
def fraud_rate(spark, sf_dir):
    return gold.fraud_rate(label_tristate(spark, sf_dir), "fraud_flag", ["lang"])


@query
def refund_pairs(spark, sf_dir):
    """Signed pairs of exactly opposite amounts by merchant state."""
    return lookups.refund_pairs(i.typed_transactions(spark, sf_dir), ["merchant_state"])


@query
def fact_asof_dim(spark, sf_dir):
    """Every order with the status version of its customer in force at the order date."""
    dim = scd2_clients(spark, sf_dir).select(
        "o_custkey", "valid_from", F.col("o_orderkey").alias("version_key"),
        F.col("o_orderstatus").alias("status_then"))
    facts = i.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return history.as_of_join(
        facts, _stored(spark, dim, "client-versions"), ["o_custkey"], "o_orderdate", "valid_from", ["version_key"],
        ["status_then", "version_key"], history.position(F.col("_at"), "ntz"))


@query
def resent_duplicates(spark, sf_dir):
    return deliveries.resent(i.raw_transactions(spark, sf_dir))


# --- rules ----------------------------------------------------------------------------------

@query
def expect_drop_tx(spark, sf_dir):
    return expectations.keep(i.typed_transactions(spark, sf_dir), k.TRANSACTION_RULES).select(
        *i.RAW_KEYS, "id", "amount", "event_ts", "card_id", "use_chip")


@query
def expect_warn_tx(spark, sf_dir):
    kept = expectations.keep(i.typed_transactions(spark, sf_dir), k.TRANSACTION_RULES)
    return expectations.warn(kept, k.TRANSACTION_RULES).select(
        *i.RAW_KEYS, F.array_join("warnings", "|").alias("warnings"))


@query
def rule_counts(spark, sf_dir):
    return expectations.rule_counts(i.typed_transactions(spark, sf_dir), k.TRANSACTION_RULES)


@query
def rule_counts_clients(spark, sf_dir):
    return expectations.rule_counts(conform.clients(i.raw_clients(spark, sf_dir)), k.CLIENT_RULES)


@query
def rule_counts_cards(spark, sf_dir):
    cards = conform.cards(conform.truncate_pan(i.raw_cards(spark, sf_dir)))
    return expectations.rule_counts(cards, k.CARD_RULES)


@query
def rule_counts_labels(spark, sf_dir):
    return expectations.rule_counts(conform.labels(i.raw_labels(spark, sf_dir)), k.LABEL_RULES)


@query
def quarantine_tx(spark, sf_dir):
    return expectations.quarantine(i.typed_transactions(spark, sf_dir), k.TRANSACTION_RULES).select(
        *i.RAW_KEYS, "id", "amount", "event_ts", "card_id", "use_chip", "card_exists", "reason")


@query
def valid_plus_quarantine(spark, sf_dir):
    judged = i.typed_transactions(spark, sf_dir).withColumn(
        "reason", expectations.reason(k.TRANSACTION_RULES))
    return judged.groupBy(F.coalesce("reason", F.lit("valid")).alias("side")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query
def quality_metrics(spark, sf_dir):
    """Rules counted for two runs, written as an event log and read back by the metrics view."""
    run = F.concat(F.lit("run-"), (F.dayofmonth("delivery_date") % 2).cast("string"))
    tx = i.typed_transactions(spark, sf_dir).withColumn("run", run)
    counts = expectations.rule_counts(tx, k.TRANSACTION_RULES, by=["run"])
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    log = deliveries.rule_log(counts, "run", F.lit("lake.silver.transactions"), at)
    return deliveries.quality_metrics(log)


@query
def reconcile_answer_key(spark, sf_dir):
    """Defects put into the deliveries against those the operators find, on distinct ids."""
    raw = i.raw_transactions(spark, sf_dir)
    looked = lookups.card_exists(
        raw.select("id", "event_date", "delivery_date", "source_file", "amount", "card_id"),
        i.current_cards(spark, sf_dir))
    classes = deliveries.classify(
        looked, {"null_amount": F.col("amount").isNull(), "unknown_card": ~F.col("card_exists")})
    seen = F.array_compact(F.array(*[
        F.when(F.col(c), F.lit(name)) for name, c in [
            ("null_amount", "null_amount"), ("unknown_card", "unknown_card"),
            ("in_file_duplicate", "in_file_duplicate"), ("resent", "is_resent"), ("late", "is_late"),
        ]]))
    return deliveries.reconcile(i.answer_key(spark, sf_dir), classes.select(F.explode(seen).alias("kind"), "id"))


@query
def reconcile_quarantine(spark, sf_dir):
    """Quarantine by reason against the answer key.

    Unconvertible amounts and cards that never existed are extra; a row with an earlier reason is missing.
    """
    reasons = F.when(F.col("kind") == "null_amount", "amount_null").when(
        F.col("kind") == "unknown_card", "card_unknown")
    expected = i.answer_key(spark, sf_dir).select(reasons.alias("kind"), "id").where("kind IS NOT NULL")
    found = expectations.quarantine(i.typed_transactions(spark, sf_dir), k.TRANSACTION_RULES).where(
        F.col("reason").isin("amount_null", "card_unknown")).select(F.col("reason").alias("kind"), "id")
    return deliveries.reconcile(expected, found)


@query
def classify_deliveries(spark, sf_dir):
    looked = lookups.card_exists(i.raw_transactions(spark, sf_dir), i.current_cards(spark, sf_dir))
    return deliveries.classify(looked, {
        "null_amount": F.col("amount").isNull(),
        "unknown_card": ~F.col("card_exists"),
        "has_new_column": F.col("device_type").isNotNull(),
    })


@query
def late_matrix(spark, sf_dir):
    return deliveries.late_matrix(i.raw_transactions(spark, sf_dir))


@query
def late_movement(spark, sf_dir):
    return deliveries.late_movement(i.raw_transactions(spark, sf_dir))


@query
def delivery_conservation(spark, sf_dir):
    return deliveries.conservation(i.raw_transactions(spark, sf_dir))


# --- history --------------------------------------------------------------------------------

@query
def scd1_transactions(spark, sf_dir):
    kept = expectations.keep(i.typed_transactions(spark, sf_dir), k.TRANSACTION_RULES)
    return history.latest(kept, ["id"], ["delivery_date", "seq"]).select(
        "id", "seq", "delivery_date", "event_ts", "amount", "card_id", "use_chip")


CARD_LOG_KEYS = ["l_orderkey", "l_linenumber"]
CARD_LOG_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


@query
def scd1_cards(spark, sf_dir):
    return history.latest(i.table(spark, sf_dir, "lineitem"), CARD_LOG_KEYS, CARD_LOG_ORDER)


@query
def scd2_clients(spark, sf_dir):
    log = i.client_log(spark, sf_dir)
    return history.versions(
        log, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"],
        history.position(F.col("o_orderdate"), "ntz"))


def _untimed_log(spark, sf_dir):
    """The change log with some records whose time is unknown; they come before all others."""
    return i.client_log(spark, sf_dir).withColumn(
        "o_orderdate", F.when(F.col("o_orderkey") % 29 != 0, F.col("o_orderdate")))


#: So small that the keys of any input are split.
TINY = GroupLimit(rows=4)


def _split_versions(spark, sf_dir):
    return history.versions(
        _untimed_log(spark, sf_dir), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderstatus"],
        history.position(F.col("o_orderdate"), "ntz"), limit=TINY)


@query
def scd2_split(spark, sf_dir):
    """Version history with the groups of hot keys split, records without a time among them."""
    return _split_versions(spark, sf_dir)


@query
def asof_split(spark, sf_dir):
    """As-of join with the groups of hot keys split; an order without a time has no version."""
    dim = _split_versions(spark, sf_dir).where("valid_from IS NOT NULL").select(
        "o_custkey", "valid_from", F.col("o_orderkey").alias("version_key"), F.col("o_orderstatus").alias("status_then"))
    facts = _untimed_log(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return history.as_of_join(
        facts, _stored(spark, dim, "split-versions"), ["o_custkey"], "o_orderdate", "valid_from", ["version_key"],
        ["status_then", "version_key"], history.position(F.col("_at"), "ntz"), limit=TINY)


@query
def scd2_current(spark, sf_dir):
    return scd2_clients(spark, sf_dir).where("is_current").drop("valid_to", "is_current")


@query
def state_as_of(spark, sf_dir):
    return history.state_as_of(
        i.client_log(spark, sf_dir), ["o_custkey"], ["o_orderdate", "o_orderkey"],
        F.col("o_orderdate"), F.lit("1998-01-01").cast("timestamp_ntz"))


@query
def state_as_of_sparse(spark, sf_dir):
    """State of every customer from records of which each holds one of three columns."""
    log = i.client_log(spark, sf_dir)
    columns = ["o_orderstatus", "o_orderpriority", "o_totalprice"]
    sparse = log.withColumns({c: F.when(F.col("o_orderkey") % 3 == n, F.col(c)) for n, c in enumerate(columns)})
    return history.state_as_of_sparse(
        sparse, ["o_custkey"], ["o_orderdate", "o_orderkey"], columns, F.col("o_orderdate"), F.lit("1998-01-01").cast("timestamp_ntz"))


# --- profiling ------------------------------------------------------------------------------

@query
def key_profile(spark, sf_dir):
    return profile.key_profile(i.raw_transactions(spark, sf_dir), "id")


@query
def key_profile_lineitem(spark, sf_dir):
    rows = i.table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", *CARD_LOG_KEYS).alias("line_key"))
    return profile.key_profile(rows, "line_key")


@query
def time_extent(spark, sf_dir):
    return profile.extent(i.raw_transactions(spark, sf_dir), "date")


@query
def count_by_capture_mode(spark, sf_dir):
    return profile.count_by(i.raw_transactions(spark, sf_dir), "use_chip")


@query
def count_by_errors(spark, sf_dir):
    return profile.count_by(i.raw_transactions(spark, sf_dir), "errors")


@query
def count_by_source_file(spark, sf_dir):
    return profile.count_by(i.raw_transactions(spark, sf_dir), "source_file")


@query
def numeric_key_sort(spark, sf_dir):
    return profile.numeric_order(i.raw_transactions(spark, sf_dir), "id").select("id", "key_number", "seq")


@query
def period_split(spark, sf_dir):
    orders = i.table(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    before, after = profile.split_period(orders, "day", "1997-01-01")
    by_year = F.substring("day", 1, 4).alias("year")
    return before.groupBy(by_year).agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "side", F.lit("backfill")
    ).unionByName(after.groupBy(by_year).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("side", F.lit("daily")))


@query
def split_reconcile(spark, sf_dir):
    orders = i.table(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    whole = _stored(spark, orders, "orders")
    parts = [_stored(spark, part, "part") for part in profile.split_period(whole, "day", "1997-01-01")]
    return profile.parts_report(whole, *parts)


@query
def load_by_variables(spark, sf_dir):
    """Session variables name the table and the day of a load, dynamic SQL runs it with parameters."""
    i.table(spark, sf_dir, "orders").createOrReplaceTempView("load_orders")
    for name, kind, value in (("load_table", "STRING", "'load_orders'"), ("load_from", "DATE", "DATE '1997-01-01'")):
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} {kind} DEFAULT {value}")
    spark.sql("SET VAR load_from = date_add(load_from, 31)")
    spark.sql("DECLARE OR REPLACE VARIABLE load_text STRING DEFAULT "
              "'SELECT o_orderkey, o_orderstatus FROM ' || load_table || ' WHERE o_orderdate >= CAST(:day AS TIMESTAMP_NTZ)'")
    return spark.sql("EXECUTE IMMEDIATE load_text USING load_from AS day")


# --- measures -------------------------------------------------------------------------------

def _valid_current(spark, sf_dir) -> DataFrame:
    kept = expectations.keep(i.typed_transactions(spark, sf_dir), k.TRANSACTION_RULES)
    return history.latest(kept, ["id"], ["delivery_date", "seq"])


@query
def volume_gross_net(spark, sf_dir):
    return gold.volumes(_valid_current(spark, sf_dir), ["use_chip"]).select(
        "use_chip", "n_rows",
        *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("gross", "refunds", "net")],
        F.round(F.col("avg_ticket").cast("double"), 4).alias("avg_ticket"))


@query
def monthly_volume(spark, sf_dir):
    month = F.date_format("event_ts", "yyyy-MM").alias("month")
    tx = _valid_current(spark, sf_dir).withColumn("status", gold.status(F.col("errors")))
    return gold.volumes(tx, [month, "status"]).select(
        "month", "status", "n_rows", F.col("net").cast("decimal(18,2)").alias("net"))


@query
def errors_by_type(spark, sf_dir):
    return gold.errors_by_type(i.typed_transactions(spark, sf_dir))


@query
def fact_transactions(spark, sf_dir):
    """Star-schema fact: valid current transactions with status and three-state flag."""
    labels = conform.labels(i.raw_labels(spark, sf_dir))
    return gold.fact_transactions(_valid_current(spark, sf_dir), labels).select(
        "id", "event_ts", "card_id", "client_id", "amount", "is_refund", "merchant_mcc", "status", "fraud_flag")


@query
def dim_category(spark, sf_dir):
    return gold.dim_category(typed_codes(spark, sf_dir))


@query
def dim_cards(spark, sf_dir):
    cards = conform.cards(conform.truncate_pan(i.raw_cards(spark, sf_dir)))
    return gold.dim_cards(expectations.keep(cards, k.CARD_RULES))


@query
def dim_clients(spark, sf_dir):
    """Typed client deliveries folded to versions over all tracked columns."""
    typed = conform.clients(i.client_deliveries(spark, sf_dir), extra=["delivered_at"])
    found = history.versions(
        expectations.keep(typed, k.CLIENT_RULES), ["id"], ["delivered_at"], k.CLIENT_TRACKED,
        history.position(F.col("delivered_at"), "ntz"))
    return gold.dim_clients(found).drop("delivered_at")


@query
def fact_client_version(spark, sf_dir):
    """Current transactions with the income of the client at the time of the event."""
    tx = _valid_current(spark, sf_dir).select("id", "event_ts", "client_id", "amount")
    clients = dim_clients(spark, sf_dir).select("id", "yearly_income", "valid_from")
    return gold.with_client_version(
        _stored(spark, tx, "transactions"), _stored(spark, clients, "clients"),
        ["yearly_income", "valid_from"], history.position(F.col("_at"), "ntz"))


# --- draws ----------------------------------------------------------------------------------

@query
def sample_exact_rate(spark, sf_dir):
    events = i.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("date").alias("event_date"), "event_type")
    return sampling.exact_rate(events, "event_date", "event_id", 0.02, "A")


@query
def weighted_bucket(spark, sf_dir):
    """Customers dealt to three parts of a split by weight."""
    parts = [("train", 80), ("tune", 15), ("test", 5)]
    return i.table(spark, sf_dir, "customer").select(
        "c_custkey", sampling.weighted("split", parts, F.col("c_custkey")).alias("part"))


@query
def device_type(spark, sf_dir):
    return i.raw_transactions(spark, sf_dir).select(
        *i.RAW_KEYS, sampling.device_type(F.col("use_chip"), F.col("event_id")).alias("device_type"))


@query
def pseudonymize(spark, sf_dir):
    clients = i.raw_clients(spark, sf_dir).select("id", "name", "ssn", "email", "gender")
    return sampling.pseudonyms(clients, "id", "s3")


# --- scans, sinks and layouts ---------------------------------------------------------------

OBJECT_ENTRIES = 50_000


def _write_objects(pairs, path: str, below: str = "") -> None:
    """Entries of two texts as JSON objects of about ``OBJECT_ENTRIES`` entries, one object in one file."""
    key, value = pairs.columns
    n = pairs.count() // OBJECT_ENTRIES + 1
    whole = F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value))))
    rows = pairs.groupBy(F.pmod(F.xxhash64(key), F.lit(n)).alias("object")).agg(whole.alias("entries"))
    body = F.to_json(F.struct(F.col("entries").alias(below))) if below else F.to_json("entries")
    rows.select("object", body.alias("value")).repartition(n, "object").write.partitionBy("object").text(path)


@query
def map_explode_labels(spark, sf_dir):
    """Labels out of JSON objects with a key per label, a file read by many tasks."""
    path = work_dir(spark, "labels")
    _write_objects(i.raw_labels(spark, sf_dir), path, "target")
    return snapshots.read_labels(spark, path).select("transaction_id", "is_fraud")


@query
def map_whole_labels(spark, sf_dir):
    """The same objects read by the reader that takes any text."""
    path = work_dir(spark, "labels-whole")
    _write_objects(i.raw_labels(spark, sf_dir), path, "target")
    return snapshots.read_labels_map(spark, path).select("transaction_id", "is_fraud")


@query
def map_explode_codes(spark, sf_dir):
    """A dictionary out of whole objects."""
    path = work_dir(spark, "codes")
    codes = i.raw_codes(spark, sf_dir).select(F.explode(F.from_json("value", "MAP<STRING, STRING>")).alias("mcc", "description"))
    _write_objects(codes, path)
    return snapshots.read_codes(spark, path).select("mcc", "description")


@query
def map_any_text(spark, sf_dir):
    """A dictionary whose texts have commas, quotation marks, braces, colons, backslashes and line breaks in them."""
    path = work_dir(spark, "any-text")
    n = F.col("c_custkey")
    odd = F.concat_ws(", ", "c_name", F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit('": {"a,": "}"}')), F.lit("\\"), F.lit("x\n,y"))
    codes = i.table(spark, sf_dir, "customer").select(
        F.when(n % 5 == 0, F.concat(F.lit(":,"), n.cast("string"))).otherwise(n.cast("string")).alias("mcc"),
        F.when(n % 3 == 0, odd).when(n % 3 == 1, F.lit(",")).otherwise(F.col("c_name")).alias("description"))
    _write_objects(codes, path)
    return snapshots.read_codes(spark, path).select("mcc", "description")


@query
def unpivot_wide_object(spark, sf_dir):
    """Customers per nation as an object with a key per nation for each market segment, read as columns, turned into rows."""
    path = work_dir(spark, "wide")
    nations = [r[0] for r in i.table(spark, sf_dir, "nation").select("n_nationkey").distinct().orderBy("n_nationkey").collect()]
    counts = i.table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(*[
        F.concat(F.col("c_mktsegment"), F.lit(":"), F.count_if(F.col("c_nationkey") == n).cast("string")).alias(f"N{n}") for n in nations])
    counts.select(F.to_json(F.struct(*[f"N{n}" for n in nations])).alias("value"), "c_mktsegment").write.partitionBy(
        "c_mktsegment").text(path)
    return snapshots.read_wide_object(spark, path).select("mcc", "description")


@query
def unpivot_codes(spark, sf_dir):
    part = i.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return snapshots.unpivot(part, ["p_partkey"], ["p_name", "p_brand", "p_type"], "attribute", "description")


@query
def json_null_fields(spark, sf_dir):
    """NULL fields survive a JSON write as keys; absent keys and NULL keys read the same."""
    path = work_dir(spark, "null-fields")
    raw = i.raw_transactions(spark, sf_dir).select(
        *i.RAW_KEYS, "id", "amount", F.col("delivery_date").alias("date_partition"))
    files.write_json_days(raw, path)
    return spark.read.option("recursiveFileLookup", True).text(path).select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("value", "$.seq").cast("int").alias("seq"),
        F.array_contains(F.json_object_keys("value"), "amount").alias("has_amount_key"),
        F.get_json_object("value", "$.amount").isNull().alias("is_null"))


def _monthly_orders(spark, sf_dir) -> str:
    path = work_dir(spark, "orders-by-month")
    orders = i.table(spark, sf_dir, "orders").withColumn("month_year", F.date_format("o_orderdate", "yyyy-MM"))
    files.write_partitioned(orders, path, "month_year")
    return path


@query
def partition_pruned_scan(spark, sf_dir):
    """A window of days out of a table in monthly folders: two folders are read."""
    return pruned_window(spark, _monthly_orders(spark, sf_dir))


def pruned_window(spark, path: str):
    return spark.read.schema(
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ, month_year STRING"
    ).parquet(path).where(
        F.col("month_year").isin("1997-01", "1997-02")
        & F.date_format("o_orderdate", "yyyy-MM-dd").between("1997-01-20", "1997-02-03")
    ).drop("month_year")


@query
def dynamic_overwrite(spark, sf_dir):
    """One month is written again with other values; all other months stay."""
    path = _monthly_orders(spark, sf_dir)
    fields = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, month_year STRING"
    again = i.table(spark, sf_dir, "orders").withColumn(
        "month_year", F.date_format("o_orderdate", "yyyy-MM")
    ).where(F.col("month_year") == "1997-01").withColumn("o_orderstatus", F.lit("R"))
    files.write_partitioned(again, path, "month_year", replace_days_only=True)
    return spark.read.schema(fields).parquet(path)


@query
def union_backfill_daily(spark, sf_dir):
    """Two folder layouts, one with a further column, read as one table by one recursive scan."""
    root = work_dir(spark, "mixed-layout")
    raw = i.raw_transactions(spark, sf_dir).select(
        *i.RAW_KEYS, "id", "amount", "device_type", F.col("delivery_date").alias("date_partition"))
    cut = F.lit(i.NEW_COLUMN_FROM).cast("date")
    backfill = raw.where(F.col("date_partition") < cut).drop("device_type").withColumn(
        "year", F.year("date_partition")).drop("date_partition")
    files.write_partitioned(backfill, f"{root}/backfill", "year", "json")
    files.write_json_days(raw.where(F.col("date_partition") >= cut), f"{root}/daily")
    fields = "event_id BIGINT, seq INT, id STRING, amount STRING, device_type STRING"
    return files.read_json(spark, root, fields, recursive=True)


@query
def snapshot_reload(spark, sf_dir):
    """Two full deliveries of a dictionary: readers see the second one only."""
    path = work_dir(spark, "snapshot")
    codes = typed_codes(spark, sf_dir)
    snapshots.reload(spark, codes, path)
    second = codes.withColumn("description", F.upper("description"))
    return snapshots.reload(spark, second, path).read()


@query
def table_file_stats(spark, sf_dir):
    """Rows of a table in files, and that it has files and bytes; how many depends on the machine."""
    path = work_dir(spark, "file-stats")
    i.table(spark, sf_dir, "orders").write.parquet(path)
    return files.file_stats(spark.read.parquet(path)).select(
        "n_rows", (F.col("n_files") > 0).alias("has_files"), (F.col("n_bytes") > F.col("n_rows")).alias("has_bytes"))


# --- streams --------------------------------------------------------------------------------

def _land_transactions(spark, sf_dir, root: str, part: str, extra: list[str] | None = None) -> str:
    """Write the first deliveries (``first``) or the repeated ones (``later``) as landing files."""
    again = part == "later"
    raw = i.raw_transactions(spark, sf_dir).where(F.col("seq") > 0 if again else F.col("seq") == 0)
    flat = raw.withColumn("shop", s.merchant_struct(F.col("merchant"))).select(
        *[c for c in k.TRANSACTION_COLUMNS if c != "merchant"], "shop.*", *(extra or []),
        F.col("delivery_date").alias("date_partition"))
    landed = conform.to_landing_transactions(flat, (extra or []) + ["date_partition"])
    landing = f"{root}/landing/transactions"
    files.write_json_days(landed, f"{landing}/{'daily' if again else 'backfill'}")
    return landing


@query
def bronze_tx_stream(spark, sf_dir):
    """Two ingestions of transaction files and a third that finds nothing new."""
    root = work_dir(spark, "bronze-tx")
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    for part in ("first", "later"):
        log.ingest(_land_transactions(spark, sf_dir, root, part))
    log.ingest(f"{root}/landing/transactions")
    shop = s.merchant_struct(F.col("merchant"))
    return log.read().select(
        *[c for c in k.TRANSACTION_COLUMNS if c != "merchant"],
        *[shop[f].alias(f) for f in k.MERCHANT_FIELDS])


@query
def bronze_clients_stream(spark, sf_dir):
    """Client CSV files whose columns come in different orders, bound by name."""
    root = work_dir(spark, "bronze-clients")
    log = bronze.BronzeLog(spark, bronze.CLIENTS, f"{root}/bronze")
    clients = i.raw_clients(spark, sf_dir)
    files.write_small_csv(clients, f"{root}/landing/clients/backfill")
    log.ingest(f"{root}/landing/clients")
    changed = clients.withColumn("yearly_income", F.concat(F.lit("$9"), F.substring("yearly_income", 2, 20)))
    files.write_small_csv(
        changed.select(*reversed(changed.columns)), f"{root}/landing/clients/daily/date_partition=2017-01-01")
    log.ingest(f"{root}/landing/clients")
    return log.read().select(*k.CLIENT_COLUMNS)


@query
def bronze_cards_load(spark, sf_dir):
    """Card files loaded twice: the second load adds nothing; no card number is stored."""
    root = work_dir(spark, "bronze-cards")
    log = bronze.BronzeLog(spark, bronze.CARDS, f"{root}/bronze")
    files.write_small_csv(i.raw_cards(spark, sf_dir), f"{root}/landing/cards/backfill")
    log.ingest(f"{root}/landing/cards")
    log.ingest(f"{root}/landing/cards")
    return log.read().drop(k.SOURCE_FILE, k.INGESTED_AT, "batch_id")


@query
def schema_evolution(spark, sf_dir):
    """A column that appears in later files is registered and filled; earlier rows have NULL."""
    root = work_dir(spark, "drift-add")
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    log.ingest(_land_transactions(spark, sf_dir, root, "first"))
    log.ingest(_land_transactions(spark, sf_dir, root, "later", [k.TRANSACTION_LATE_COLUMN]))
    return log.read().select("id", "amount", "device_type")


@query
def rescued_data(spark, sf_dir):
    """All deliveries under the rescue policy: the schema stays, the values are kept aside."""
    root = work_dir(spark, "drift-rescue")
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    for part in ("first", "later"):
        log.ingest(_land_transactions(spark, sf_dir, root, part, [k.TRANSACTION_LATE_COLUMN]), on_new_columns=drift.RESCUE)
    return log.read().select(
        "id", "amount", F.get_json_object(k.RESCUED, "$.device_type").alias("rescued_device_type"))


@query
def drift_ignore(spark, sf_dir):
    """All deliveries under the ignore policy: neither column nor rescued values."""
    root = work_dir(spark, "drift-ignore")
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    for part in ("first", "later"):
        log.ingest(_land_transactions(spark, sf_dir, root, part, [k.TRANSACTION_LATE_COLUMN]), on_new_columns=drift.IGNORE)
    return log.read().select("id", "amount", F.col(k.RESCUED).isNull().alias("nothing_rescued"))


@query
def drift_fail(spark, sf_dir):
    """Under the fail policy files with a new column stop the feed; what came before stays, and nothing else."""
    root = work_dir(spark, "drift-fail")
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    log.ingest(_land_transactions(spark, sf_dir, root, "later"), on_new_columns=drift.FAIL)
    _land_transactions(spark, sf_dir, root, "first", [k.TRANSACTION_LATE_COLUMN])
    try:
        log.ingest(f"{root}/landing/transactions", on_new_columns=drift.FAIL)
        stopped = False
    except StreamingQueryException:
        stopped = True
    return log.read().select("id", "amount", F.lit(stopped).alias("stopped"))


@query
def lineage(spark, sf_dir):
    """Every stored row has the file it came from and when it was taken."""
    root = work_dir(spark, "lineage")
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    for part in ("first", "later"):
        log.ingest(_land_transactions(spark, sf_dir, root, part))
    day = F.regexp_extract(k.SOURCE_FILE, "date_partition=([0-9-]+)/", 1)
    return log.read().groupBy(day.alias("delivery_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(k.INGESTED_AT).alias("n_timed"))


@query
def full_refresh(spark, sf_dir):
    """A new generation takes all files again; the old one stays as it was."""
    root = work_dir(spark, "refresh")
    for part in ("first", "later"):
        landing = _land_transactions(spark, sf_dir, root, part)
    logs = [bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze", generation=g) for g in (1, 2)]
    for log in logs:
        log.ingest(landing)
    return logs[0].read().select("id", "amount", F.lit(1).alias("generation")).unionByName(
        logs[1].read().select("id", "amount", F.lit(2).alias("generation")))


def _csv_clients(spark, sf_dir) -> str:
    path = work_dir(spark, "csv")
    files.write_small_csv(i.raw_clients(spark, sf_dir), path)
    return path


@query
def csv_text_scan(spark, sf_dir):
    """CSV read with a schema of texts: nothing is converted."""
    return files.read_csv(spark, _csv_clients(spark, sf_dir), k.CLIENT_COLUMNS).select("id", "yearly_income", "latitude", "num_credit_cards")


@query
def csv_line_breaks(spark, sf_dir):
    """Client files, some with line breaks, commas and quotes in their addresses, ingested."""
    root = work_dir(spark, "line-breaks")
    log = bronze.BronzeLog(spark, bronze.CLIENTS, f"{root}/bronze")
    clients = i.raw_clients(spark, sf_dir)
    odd = F.col("id").cast("bigint") % 3 == 0
    broken = clients.where(odd).withColumn("address", F.concat("address", F.lit("\n2nd floor, \"left\"\n"), "id"))
    files.write_small_csv(clients.where(~odd), f"{root}/landing/clients/plain")
    files.write_small_csv(broken, f"{root}/landing/clients/broken")
    log.ingest(f"{root}/landing/clients")
    return log.read().select("id", "address", "num_credit_cards", F.col(k.RESCUED).isNull().alias("nothing_rescued"))


@query
def csv_inferred_scan(spark, sf_dir):
    """CSV read with inferred types."""
    return files.read_csv(spark, _csv_clients(spark, sf_dir), infer=True).select(
        F.col("id").cast("bigint").alias("id"), "latitude", F.col("num_credit_cards").cast("bigint").alias("num_credit_cards"))


@query
def csv_plain_scan(spark, sf_dir):
    """CSV read without a schema and without inference: all columns are texts."""
    return files.read_csv(spark, _csv_clients(spark, sf_dir)).select("id", "latitude", "credit_score")


@query
def json_folder_scan(spark, sf_dir):
    """JSON Lines in daily folders; the folder's day becomes a column, and the parent folder is one table."""
    path = work_dir(spark, "json-days")
    raw = i.raw_transactions(spark, sf_dir).select(*i.RAW_KEYS, "id", "amount", F.col("delivery_date").alias("date_partition"))
    files.write_json_days(raw, path)
    return files.read_json(spark, path, "event_id BIGINT, seq INT, id STRING, amount STRING, date_partition DATE")


@query
def sorted_by_count(spark, sf_dir):
    """Counts in descending order, with the place of each row in the sorted output."""
    return _placed(profile.count_by(i.raw_transactions(spark, sf_dir), "use_chip"))


@query
def sorted_by_key(spark, sf_dir):
    """Keys in numeric order, with the place of each row in the sorted output."""
    ordered = profile.numeric_order(i.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id")), "id")
    return _placed(ordered.select("id"))


def _placed(df):
    """Rows of a sorted table with their place: sorted and stored in ranges, numbered in each, the ranges' sizes added up."""
    return profile.placed(df, work_dir(df.sparkSession, "sorted"))


def _silver_cards(spark, sf_dir, root: str, late: bool = False) -> silver.SilverTable:
    """Customers landed as whole card records, loaded and applied; the odd ones only afterwards if ``late``."""
    cards = silver.SilverTable(
        spark, silver.CARDS, bronze.BronzeLog(spark, bronze.CARDS, f"{root}/bronze"), f"{root}/silver")
    _deliver_cards(spark, sf_dir, root, cards, F.col("c_custkey") % 2 == 0 if late else F.lit(True))
    cards.compact()
    return cards


def _deliver_cards(spark, sf_dir, root: str, cards: silver.SilverTable, which: F.Column) -> None:
    rows = i.card_records(i.table(spark, sf_dir, "customer").where(which).select(
        F.col("c_custkey").alias("p_partkey"), F.col("c_mktsegment").alias("p_brand"), F.lit("Debit").alias("p_type"),
        F.col("c_acctbal").alias("p_retailprice")))
    files.write_small_csv(rows, f"{root}/landing/cards/run={cards.last_batch() + 1}")
    cards.bronze.ingest(f"{root}/landing/cards")
    cards.drain("run")


def _silver_transactions(spark, sf_dir, root: str) -> silver.SilverTable:
    """Both parts of the deliveries ingested and applied in a run each, compacted in between."""
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    tx = silver.transactions(spark, log, f"{root}/silver", _silver_cards(spark, sf_dir, root))
    for n, part in enumerate(("first", "later"), 1):
        log.ingest(_land_transactions(spark, sf_dir, root, part))
        tx.drain(f"run-{n}")
        if n == 1:
            tx.compact()
    return tx


@query
def silver_transactions(spark, sf_dir):
    """Landing files to the current table, in two runs with a compaction between them."""
    tx = _silver_transactions(spark, sf_dir, work_dir(spark, "silver-tx"))
    return tx.read().select("id", "event_ts", "amount", "card_id", "use_chip", "merchant_zip")


@query
def silver_quarantine(spark, sf_dir):
    tx = _silver_transactions(spark, sf_dir, work_dir(spark, "silver-quarantine"))
    return tx.quarantine().select("id", "amount", "event_ts", "card_id", "use_chip", "reason")


@query
def silver_requeue(spark, sf_dir):
    """Half of the cards come after the transactions: the rows that waited for them are judged again, once."""
    root = work_dir(spark, "silver-requeue")
    log = bronze.BronzeLog(spark, bronze.TRANSACTIONS, f"{root}/bronze")
    cards = _silver_cards(spark, sf_dir, root, late=True)
    tx = silver.transactions(spark, log, f"{root}/silver", cards)
    for part in ("first", "later"):
        landing = _land_transactions(spark, sf_dir, root, part)
    log.ingest(landing)
    tx.drain("run-1")
    tx.compact()
    _deliver_cards(spark, sf_dir, root, cards, F.col("c_custkey") % 2 == 1)
    tx.requeue("run-2")
    tx.requeue("run-3")  # finds nothing to do
    tx.compact()
    kept = tx.read().select("id", "amount", "card_id", F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(tx.quarantine().select("id", "amount", "card_id", "reason"))


@query
def silver_quality_metrics(spark, sf_dir):
    """Metrics view over the counters that the two runs collected while writing."""
    tx = _silver_transactions(spark, sf_dir, work_dir(spark, "silver-metrics"))
    return deliveries.quality_metrics(silver.event_log([tx])).drop("measured_at")


@query
def silver_cards(spark, sf_dir):
    """Card files, then changed records for all of them: the later delivery wins."""
    root = work_dir(spark, "silver-cards")
    log = bronze.BronzeLog(spark, bronze.CARDS, f"{root}/bronze")
    cards = silver.SilverTable(spark, silver.CARDS, log, f"{root}/silver")
    raw = i.raw_cards(spark, sf_dir)
    changed = raw.withColumn("credit_limit", F.lit("$12400"))
    for folder, rows in (("backfill", raw), ("daily/date_partition=2017-01-01", changed)):
        files.write_small_csv(rows, f"{root}/landing/cards/{folder}")
        log.ingest(f"{root}/landing/cards")
        cards.drain("run")
    return cards.read().drop(k.SOURCE_FILE, k.INGESTED_AT, "batch_id", "row_hash")


@query
def silver_clients(spark, sf_dir):
    """Three client deliveries: first, unchanged, changed income. Two versions per client."""
    root = work_dir(spark, "silver-clients")
    log = bronze.BronzeLog(spark, bronze.CLIENTS, f"{root}/bronze")
    clients = silver.SilverTable(spark, silver.CLIENTS, log, f"{root}/silver")
    raw = i.raw_clients(spark, sf_dir)
    changed = raw.withColumn("yearly_income", F.lit("$64200"))
    for day, rows in enumerate((raw, raw, changed), 1):
        files.write_small_csv(rows, f"{root}/landing/clients/daily/date_partition=2017-01-0{day}")
        log.ingest(f"{root}/landing/clients")
        clients.drain(f"run-{day}")
        if day == 2:
            clients.compact()
    return clients.read().select(
        "id", "yearly_income", "total_debt", "valid_from_date", "is_current",
        F.col("valid_to").isNull().alias("is_open"))


@query
def silver_labels(spark, sf_dir):
    """Label snapshot: landed as JSON, loaded, judged and published."""
    root = work_dir(spark, "silver-labels")
    i.raw_labels(spark, sf_dir).select(
        F.create_map("transaction_id", "is_fraud").alias("target")).write.json(f"{root}/landing")
    loaded = snapshots.reload(
        spark, snapshots.read_labels_map(spark, f"{root}/landing", multi_line=False), f"{root}/bronze")
    target = silver.labels(spark, f"{root}/silver")
    target.refresh(loaded.read(), "run-1")
    return target.read().select("transaction_id", "is_fraud")
