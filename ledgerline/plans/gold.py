"""Star schema and measures on the Silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contracts import LINEAGE, RESCUED
from ledgerline.operators.history import as_of_join


def dim_category(codes: DataFrame) -> DataFrame:
    """Merchant categories. The merchant itself is no dimension: only its number is known."""
    return codes.select("mcc", "description")


def dim_cards(cards: DataFrame) -> DataFrame:
    """Current cards; their changes overwrite."""
    return cards.drop(*LINEAGE, "batch_id", "row_hash")


def dim_clients(clients: DataFrame) -> DataFrame:
    """Client versions with their validity."""
    return clients.drop(*LINEAGE, RESCUED, "batch_id", "row_hash")


def status(errors: Column) -> Column:
    """No error text means approved."""
    return F.when(errors.isNull() | (F.size(errors) == 0), "approved").otherwise("declined")


def fact_transactions(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """Transactions with status and a three-state fraud flag: true, false or NULL (not evaluated)."""
    known = labels.select(F.col("transaction_id").alias("_tx"), F.col("is_fraud").alias("fraud_flag"))
    return (
        tx.join(known, F.col("id") == F.col("_tx"), "left")
        .drop("_tx")
        .withColumn("status", status(F.col("errors")))
    )


def fraud_rate(facts: DataFrame, flag: str, by: list[str]) -> DataFrame:
    """Share of fraud among the evaluated rows; rows without a label are in no denominator."""
    return facts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(flag).alias("n_evaluated"),
        F.count_if(F.col(flag)).alias("n_fraud"),
        F.avg(F.col(flag).cast("int")).alias("fraud_rate"),
    )


def volumes(tx: DataFrame, by: list) -> DataFrame:
    """Gross volume (purchases), refunds, net volume, and the average ticket without refunds."""
    refund, amount = F.col("is_refund"), F.col("amount")
    return tx.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.when(~refund, amount).otherwise(0)).alias("gross"),
        F.sum(F.when(refund, -amount).otherwise(0)).alias("refunds"),
        F.sum(amount).alias("net"),
        F.avg(F.when(~refund, amount)).alias("avg_ticket"),
    )


def errors_by_type(tx: DataFrame) -> DataFrame:
    """Declines per error type; a row with two errors counts under both."""
    return tx.select(F.explode("errors").alias("error_type")).groupBy("error_type").agg(
        F.count(F.lit(1)).alias("n_errors")
    )


def with_client_version(tx: DataFrame, clients: DataFrame, take: list[str], position: Column,
                        counted: DataFrame | None = None) -> DataFrame:
    """Transactions with the client version in force at the event."""
    return as_of_join(
        tx, clients.withColumnRenamed("id", "client_id"), ["client_id"], "event_ts", "valid_from",
        ["valid_from"], take, position, counted=counted,
    )
