"""The five sources wired from landing files to Silver and the quality metrics, below one root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators import deliveries
from ledgerline.sources import drift, snapshots
from ledgerline.sources.versions import ReplacedTable
from ledgerline.streaming import bronze, silver


class Lake:
    """Environments are kept apart by their ``root``; nothing else names a place.

    Every step can be run on its own and repeated. Cards come before transactions, which look
    their card up in them; Silver starts after Bronze has drained.
    """

    def __init__(self, spark: SparkSession, root: str, generation: int = 1):
        self.spark, self.root = spark, root.rstrip("/")
        at_bronze, at_silver = f"{self.root}/bronze", f"{self.root}/silver/generation={generation}"
        logs = [bronze.BronzeLog(spark, e, at_bronze, generation)
                for e in (bronze.CARDS, bronze.CLIENTS, bronze.TRANSACTIONS)]
        self.bronze = {log.entity.name: log for log in logs}
        self.bronze_codes = ReplacedTable(spark, f"{at_bronze}/mcc_codes")
        self.bronze_labels = ReplacedTable(spark, f"{at_bronze}/fraud_labels")
        self.cards = silver.SilverTable(spark, silver.CARDS, self.bronze["cards"], at_silver)
        self.clients = silver.SilverTable(spark, silver.CLIENTS, self.bronze["clients"], at_silver)
        self.transactions = silver.transactions(spark, self.bronze["transactions"], at_silver, self.cards)
        self.codes, self.labels = silver.codes(spark, at_silver), silver.labels(spark, at_silver)

    def landing(self, entity: str) -> str:
        return f"{self.root}/landing/{entity}"

    def ingest(self, entity: str, on_new_columns: str = drift.ADD) -> None:
        self.bronze[entity].ingest(self.landing(entity), on_new_columns)

    def load_codes(self, path: str) -> None:
        self.bronze_codes.publish(snapshots.read_codes(self.spark, path))

    def load_labels(self, path: str) -> None:
        self.bronze_labels.publish(snapshots.read_labels(self.spark, path))

    def apply(self, entity: str, run_id: str) -> None:
        """Bring one Silver table up to date with its Bronze."""
        if entity == "mcc_codes":
            self.codes.refresh(self.bronze_codes.read(), run_id)
        elif entity == "fraud_labels":
            self.labels.refresh(self.bronze_labels.read(), run_id)
        else:
            {"cards": self.cards, "clients": self.clients, "transactions": self.transactions}[entity].drain(run_id)

    def requeue(self, run_id: str) -> int:
        """Transactions that waited in quarantine for cards which have come; returns how many were judged again."""
        return self.transactions.requeue(run_id)

    def compact(self, transactions_after: int = 1) -> None:
        """Merge new batches into the tables; a merge writes the buckets of the new keys only."""
        self.cards.compact()
        self.clients.compact()
        self.transactions.compact(transactions_after)

    def quality_metrics(self) -> DataFrame:
        tables = [self.transactions, self.clients, self.cards, self.codes, self.labels]
        return deliveries.quality_metrics(silver.event_log(tables))
