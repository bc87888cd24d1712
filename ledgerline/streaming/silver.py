"""Incremental Silver: typed, judged by the rules, applied by key.

A micro-batch of Bronze is typed, judged and written once, valid rows and quarantine side by side
in ``log/batch_id=N/verdict=...``; the rule counters are collected by the same write. The table
lies in hash buckets of the key and holds the batches up to its last merge. Reading folds the later
batches into the buckets of their keys and takes all other buckets as they are; a merge
(:meth:`SilverTable.compact`) writes those buckets and no others. The log is not read again: where
history is kept, a bucket also has the records that its versions absorbed, so that a record that
comes late finds its place.

What a batch looks up in another table is pinned before the batch is judged. A repeated batch
reads the same content, whatever came meanwhile. Rows that failed only because what they looked up
was not there yet wait in quarantine; :meth:`SilverTable.requeue` judges them again once it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline import contracts as k
from ledgerline.functions.scalars import delivery_date
from ledgerline.operators import conform, deliveries, expectations, history, lookups
from ledgerline.operators.groups import GroupLimit
from ledgerline.sources import notes
from ledgerline.sources.buckets import BucketedTable, State
from ledgerline.sources.versions import ReplacedTable
from ledgerline.streaming.bronze import BronzeLog

VALID, QUARANTINE = "valid", "quarantine"
_COUNTERS = "rule STRING, passed BIGINT, failed BIGINT, run_id STRING, table_name STRING, measured_at TIMESTAMP"


@dataclass(frozen=True)
class Flow:
    name: str
    conform: Callable[[DataFrame], DataFrame]
    rules: list[k.Rule]
    tracked: list[str] = field(default_factory=list)  # empty: latest row only


TRANSACTIONS = Flow("transactions", conform.transactions, k.TRANSACTION_RULES)
CARDS = Flow("cards", conform.cards, k.CARD_RULES)
CLIENTS = Flow("clients", conform.clients, k.CLIENT_RULES, k.CLIENT_TRACKED)

# A later delivery wins; the path decides inside one ingestion and a hash of the row inside a file.
ORDER = [k.INGESTED_AT, k.SOURCE_FILE, "row_hash"]


class Counters:
    """Rule counters of a table: a few rows per batch (or snapshot version)."""

    def __init__(self, spark: SparkSession, path: str, table_name: str):
        self.spark, self.path, self.table_name = spark, path, table_name

    def write(self, batch_id: int, lines: list[tuple[str, int, int]], run_id: str) -> None:
        self.spark.createDataFrame(lines, "rule STRING, passed BIGINT, failed BIGINT").select(
            "*", F.lit(run_id).alias("run_id"), F.lit(self.table_name).alias("table_name"),
            F.current_timestamp().alias("measured_at"),
        ).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read(self) -> DataFrame:
        schema = f"{_COUNTERS}, batch_id BIGINT"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


@dataclass(frozen=True)
class Lookup:
    """What the rules need from ``table``: ``add`` joins its content to typed rows by ``key``. Rows that fail for
    ``reason`` wait for their key to come."""

    table: "SilverTable"
    add: Callable[[DataFrame, DataFrame], DataFrame]
    key: str
    reason: str
    adds: list[str]


class SilverTable:
    """``n_buckets`` is fixed by the first merge; it should grow with the table that is expected."""

    def __init__(self, spark: SparkSession, flow: Flow, bronze: BronzeLog, root: str,
                 lookup: Lookup | None = None, limit: GroupLimit = GroupLimit(), n_buckets: int = 16):
        self.spark, self.flow, self.bronze, self.lookup, self.limit = spark, flow, bronze, lookup, limit
        base = f"{root.rstrip('/')}/{flow.name}"
        self.log, self.checkpoint = f"{base}/log", f"{base}/checkpoint"
        self.pins, self.requeued, self.rounds = f"{base}/pins", f"{base}/requeued", f"{base}/rounds"
        self.counters = Counters(spark, f"{base}/counters", flow.name)
        self.table = BucketedTable(spark, f"{base}/table", ["id"], n_buckets, ["kind"] if flow.tracked else [])

    def judge(self, rows: DataFrame, pinned: int | None = None) -> DataFrame:
        """Bronze rows typed, with ``reason`` and ``verdict``; looked up in the content of batch ``pinned``."""
        return self._verdict(self.flow.conform(rows), pinned)

    def _verdict(self, typed: DataFrame, pinned: int | None, but: list[str] | None = None) -> DataFrame:
        """``but`` are columns that are no part of the row: its hash is the same whenever it is judged."""
        if self.lookup:
            typed = self.lookup.add(typed, self.lookup.table.read(pinned))
        return (
            typed.withColumn("reason", expectations.reason(self.flow.rules))
            .withColumn("row_hash", F.xxhash64(*[c for c in typed.columns if c not in (but or ())]))
            .withColumn("verdict", F.when(F.col("reason").isNull(), VALID).otherwise(QUARANTINE))
        )

    def drain(self, run_id: str, max_batches: int = 100) -> None:
        """Process the complete Bronze batches this table has not seen, then stop.

        The stream carries the completion markers, so rows of a batch that failed half-way are never judged.
        """
        if self.bronze.last_batch() < 0:
            return

        def apply(markers: DataFrame, n: int) -> None:
            ids = sorted(r.batch_id for r in markers.select("batch_id").distinct().collect())
            self._apply(self.bronze.rows_of(ids), n, run_id)
        (
            self.bronze.committed(maxFilesPerTrigger=max_batches)
            .writeStream.foreachBatch(apply)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )

    def _apply(self, batch: DataFrame, batch_id: int, run_id: str) -> None:
        if batch_id <= self.last_batch():
            return  # done before a restart
        counts = Observation()
        judged = expectations.observe(self.judge(batch, self._pin(batch_id)), self.flow.rules, counts)
        judged.write.mode("overwrite").partitionBy("verdict").parquet(f"{self.log}/batch_id={batch_id}")
        lines = expectations.observed_counts(self.flow.rules, counts)
        # written last: a batch without its counters is not complete and is not read
        self.counters.write(batch_id, lines, run_id)

    def _pin_of(self, batch_id: int) -> str:
        return f"{self.pins}/{batch_id:012d}.json"

    def _pin(self, batch_id: int) -> int | None:
        """The batch of the looked up table that a batch is judged by, noted before it is judged for the first time."""
        if self.lookup is None:
            return None
        noted = notes.read(self.spark, self._pin_of(batch_id))
        if noted:
            return noted["upto"]
        upto = self.lookup.table.last_batch()
        notes.write(self.spark, self._pin_of(batch_id), {"upto": upto})
        return upto

    def last_batch(self) -> int:
        return notes.last(self.spark, self.counters.path, "batch_id")

    def _judged(self, verdict: str, upto: int, after: int = -1) -> DataFrame:
        """Rows of the batches ``after`` .. ``upto``; both conditions prune folders."""
        if upto <= after:
            return self.spark.createDataFrame([], self._log_schema).drop("verdict")
        return (
            self.spark.read.schema(self._log_schema).parquet(self.log)
            .where(
                (F.col("verdict") == verdict)
                & (F.col("batch_id") > after) & (F.col("batch_id") <= upto)
            )
            .drop("verdict")
        )

    @cached_property
    def _log_schema(self):
        nothing = self.spark.createDataFrame([], f"{self.bronze.schema()}, batch_id BIGINT")
        shape = self.judge(nothing).drop("verdict")
        return shape.withColumns({
            "batch_id": F.lit(None).cast("bigint"), "verdict": F.lit(None).cast("string"),
        }).schema

    # --- quarantine and requeue -----------------------------------------------------------------

    def last_round(self) -> int:
        """The last round of requeueing that is complete."""
        return len(notes.names(self.spark, self.rounds)) - 1

    def _released(self, upto: int, after: int = -1) -> DataFrame:
        """Rows judged again; ``was_hash`` and ``batch_id`` name the quarantined row."""
        shape = self.spark.createDataFrame([], self._log_schema).withColumns({
            "was_hash": F.lit(None).cast("bigint"), "round": F.lit(None).cast("bigint")}).schema
        if upto <= after:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).parquet(self.requeued).where((F.col("round") > after) & (F.col("round") <= upto))

    def _waiting(self) -> DataFrame:
        """Quarantined rows of the log that were not judged again."""
        rows, upto = self._judged(QUARANTINE, self.last_batch()), self.last_round()
        if upto < 0:
            return rows
        done = self._released(upto).select(F.col("was_hash").alias("row_hash"), "batch_id").distinct()
        return rows.join(done, ["row_hash", "batch_id"], "left_anti").select(*rows.columns)

    def quarantine(self) -> DataFrame:
        """Rows that are in quarantine now: judged again or not, each by its last verdict."""
        rows = self._waiting()
        again = self._released(self.last_round()).where(F.col("verdict") == QUARANTINE)
        return rows.unionByName(again.select(*rows.columns))

    def requeue(self, run_id: str) -> int:
        """Judge rows again that waited for a key which has come since; returns how many rows that were.

        Only keys that came after the oldest content by which a waiting row was judged can matter. A row leaves the
        quarantine of its batch when it is judged again, whatever the verdict is now. Counters of rules stay those of
        the first judgement. Nothing is done twice: a round counts once its marker is written.
        """
        if self.lookup is None:
            return 0
        waiting = self._waiting().where(F.col("reason") == self.lookup.reason)
        first = waiting.agg(F.min("batch_id").alias("n")).first().n  # pins never fall from batch to batch
        pinned = self.lookup.table.last_batch()
        oldest = pinned if first is None else notes.read(self.spark, self._pin_of(first))["upto"]
        if oldest >= pinned:
            return 0
        came = self.lookup.table._judged(VALID, pinned, after=oldest).select(F.col("id").alias(self.lookup.key)).distinct()
        typed = waiting.join(came, self.lookup.key, "left_semi").select(*waiting.columns).withColumnRenamed(
            "row_hash", "was_hash").drop("reason", *self.lookup.adds)
        again = self._verdict(typed, pinned, but=["was_hash", "batch_id"])
        number, counted = self.last_round() + 1, Observation()
        again.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").partitionBy("verdict").parquet(
            f"{self.requeued}/round={number}")
        n = counted.get["n"]
        if n:
            notes.write(self.spark, f"{self.rounds}/{number:012d}.json", {"n_rows": n, "run_id": run_id})
        return n

    # --- the table ------------------------------------------------------------------------------

    def _fold(self, rows: DataFrame) -> DataFrame:
        if not self.flow.tracked:
            return history.latest(rows, ["id"], ORDER)
        # rows of one ingestion time are one micro-batch, whose size is limited where it is formed
        found = history.versions_and_absorbed(
            rows, ["id"], ORDER, self.flow.tracked,
            history.position(F.col(k.INGESTED_AT), "timestamp"), limit=self.limit,
        )
        # ingestion time is an order of arrival; the path tells the business day, if it has one
        return found.withColumn("valid_from_date", F.when(
            F.col("kind") == history.VERSION, delivery_date(F.col(k.SOURCE_FILE))))

    @cached_property
    def _table_schema(self):
        return self._fold(self.spark.createDataFrame([], self._log_schema).drop("verdict", "reason")).schema

    def _records(self, folded: DataFrame) -> DataFrame:
        """Table rows as the log has them."""
        return folded.select(*[f.name for f in self._log_schema if f.name not in ("verdict", "reason")])

    def _fresh(self, state: State | None, last: int, last_round: int) -> DataFrame | None:
        """Valid rows that the table has not taken in, None if there can be none."""
        marks = state.marks if state else {"batch": -1, "round": -1}
        if last <= marks["batch"] and last_round <= marks["round"]:
            return None
        rows = self._judged(VALID, last, after=marks["batch"])
        if last_round > marks["round"]:
            rows = rows.unionByName(self._released(last_round, after=marks["round"]).where(
                F.col("verdict") == VALID).select(*rows.columns))
        return rows.drop("reason")

    def _changed(self, state: State | None, fresh: DataFrame, touched: list[int]) -> DataFrame:
        """New content of the touched buckets. Keys without new rows are taken over as they are."""
        there = self.table.read(state, self._table_schema, buckets=touched)
        if not self.flow.tracked:
            return self._fold(self._records(there).unionByName(fresh))
        keys = fresh.select("id").distinct()
        again = self._records(there.join(keys, "id", "left_semi")).unionByName(fresh)
        return there.join(keys, "id", "left_anti").unionByName(self._fold(again))

    def _visible(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("kind") == history.VERSION).drop("kind") if self.flow.tracked else rows

    def read(self, upto: int | None = None) -> DataFrame:
        """Latest rows, or version history where the flow tracks columns; as of batch ``upto`` if one is given."""
        state, last = self.table.state(), self.last_batch()
        if upto is not None and upto < last:
            if state and state.marks["batch"] > upto:  # the table is ahead: what there was then is in the log
                return self._visible(self._fold(self._judged(VALID, upto).drop("reason")))
            last = upto
        fresh = self._fresh(state, last, self.last_round())
        if fresh is None:
            return self._visible(self.table.read(state, self._table_schema))
        if state is None:
            return self._visible(self._fold(fresh))
        touched = self.table.touched(fresh, state)
        untouched = self.table.read(state, self._table_schema, but=touched)
        return self._visible(untouched.unionByName(self._changed(state, fresh, touched)))

    def compact(self, after_batches: int = 1) -> bool:
        """Merge the rows of newer batches into the buckets of their keys, if at least that many batches came since, or
        a round of requeueing; readers switch at once."""
        state, last, last_round = self.table.state(), self.last_batch(), self.last_round()
        marks = state.marks if state else {"batch": -1, "round": -1}
        if last - marks["batch"] < after_batches and last_round <= marks["round"]:
            return False
        fresh = self._fresh(state, last, last_round)
        if fresh is None:
            return False
        touched = self.table.touched(fresh, state) if state else list(range(self.table.n_buckets))
        self.table.replace(self._changed(state, fresh, touched), touched, state, {"batch": last, "round": last_round})
        return True


def transactions(spark: SparkSession, bronze: BronzeLog, root: str, cards: SilverTable, **options) -> SilverTable:
    """Transactions look their card up in the current cards at the time they are first processed."""
    known = Lookup(cards, lookups.card_exists, "card_id", "card_unknown", ["card_exists"])
    return SilverTable(spark, TRANSACTIONS, bronze, root, lookup=known, **options)


class SnapshotTable:
    """A Silver table recomputed from a whole Bronze snapshot."""

    def __init__(self, spark: SparkSession, name: str, conform: Callable[[DataFrame], DataFrame],
                 rules: list[k.Rule], root: str):
        self.conform, self.rules = conform, rules
        base = f"{root.rstrip('/')}/{name}"
        self.table = ReplacedTable(spark, f"{base}/table")
        self.counters = Counters(spark, f"{base}/counters", name)

    def refresh(self, snapshot: DataFrame, run_id: str) -> None:
        """Apply the drop rules and publish; the counters come from the same pass."""
        counts = Observation()
        typed = expectations.observe(self.conform(snapshot), self.rules, counts)
        version = self.table.publish(expectations.keep(typed, self.rules))
        self.counters.write(version, expectations.observed_counts(self.rules, counts), run_id)

    def read(self) -> DataFrame:
        return self.table.read()


def labels(spark: SparkSession, root: str) -> SnapshotTable:
    return SnapshotTable(spark, "fraud_labels", conform.labels, k.LABEL_RULES, root)


def codes(spark: SparkSession, root: str) -> SnapshotTable:
    return SnapshotTable(spark, "mcc_codes", conform.codes, k.CODE_RULES, root)


def event_log(tables: list[SilverTable | SnapshotTable]) -> DataFrame:
    """Rule counters of the tables as event log rows, as :func:`deliveries.quality_metrics` reads them."""
    counters = reduce(DataFrame.unionByName, [t.counters.read() for t in tables])
    dataset = F.concat(F.lit("lake.silver."), F.col("table_name"))
    return deliveries.rule_log(
        counters, "run_id", dataset, F.max("measured_at"), by=["table_name", "batch_id"])
