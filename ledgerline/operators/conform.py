"""Typing of the Bronze text columns, one projection per entity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.contracts import INGESTED_AT, LINEAGE, MERCHANT_FIELDS, RESCUED
from ledgerline.functions import scalars as s


def _carried(df: DataFrame, names: list[str]) -> list[Column]:
    """Lineage columns, NULL where the input has none."""
    types = {INGESTED_AT: "timestamp"}
    return [
        F.col(n) if n in df.columns else F.lit(None).cast(types.get(n, "string")).alias(n)
        for n in names
    ]


def transactions(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Typed transactions. ``extra`` names input columns to keep as they are."""
    shop = F.col("_shop")
    return raw.withColumn("_shop", s.merchant_struct(F.col("merchant"))).select(
        *(extra or []),
        "id",
        s.event_time(F.col("date")).alias("event_ts"),
        "client_id",
        "card_id",
        s.money(F.col("amount")).alias("amount"),
        (s.money(F.col("amount")) < 0).alias("is_refund"),
        "use_chip",
        shop["merchant_id"].alias("merchant_id"),
        shop["merchant_city"].alias("merchant_city"),
        shop["merchant_state"].alias("merchant_state"),
        s.zip5(shop["zip"]).alias("merchant_zip"),
        shop["mcc"].alias("merchant_mcc"),
        s.error_list(F.col("errors")).alias("errors"),
        *_carried(raw, [RESCUED, *LINEAGE]),
    )


def clients(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    def c(name: str) -> Column:
        return F.col(name)

    return raw.select(
        *(extra or []),
        "id", "name", "ssn", "email",
        c("current_age").try_cast("int").alias("current_age"),
        c("retirement_age").try_cast("int").alias("retirement_age"),
        s.first_of_month(c("birth_year"), c("birth_month")).alias("birth_date"),
        "gender", "address",
        c("latitude").try_cast("double").alias("latitude"),
        c("longitude").try_cast("double").alias("longitude"),
        s.money(c("per_capita_income")).alias("per_capita_income"),
        s.money(c("yearly_income")).alias("yearly_income"),
        s.money(c("total_debt")).alias("total_debt"),
        c("credit_score").try_cast("int").alias("credit_score"),
        c("num_credit_cards").try_cast("int").alias("num_credit_cards"),
        *_carried(raw, [RESCUED, *LINEAGE]),
    )


def truncate_pan(raw: DataFrame) -> DataFrame:
    """Drop the CVV and keep only the first six and last four digits of the card number."""
    return raw.select(
        *[n for n in raw.columns if n not in ("cvv", "card_number")],
        s.card_bin(F.col("card_number")).alias("card_bin"),
        s.card_last4(F.col("card_number")).alias("card_last4"),
    )


def cards(raw: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Typed cards, from rows that :func:`truncate_pan` has already been applied to."""
    leaked = {"cvv", "card_number"} & set(raw.columns)
    if leaked:
        raise ValueError(f"card data must be truncated before typing, found {sorted(leaked)}")
    return raw.select(
        *(extra or []),
        "id", "client_id", "card_brand", "card_type",
        s.month_end(F.col("expires")).alias("expires_on"),
        s.yes_no(F.col("has_chip")).alias("has_chip"),
        F.col("num_cards_issued").try_cast("int").alias("num_cards_issued"),
        s.money(F.col("credit_limit")).alias("credit_limit"),
        s.month_start(F.col("acct_open_date")).alias("opened_on"),
        F.col("year_pin_last_changed").try_cast("int").alias("pin_changed_year"),
        s.yes_no(F.col("card_on_dark_web")).alias("on_dark_web"),
        "card_bin", "card_last4",
        *_carried(raw, LINEAGE),
    )


def labels(raw: DataFrame) -> DataFrame:
    return raw.select(
        "transaction_id", s.yes_no(F.col("is_fraud")).alias("is_fraud"), *_carried(raw, LINEAGE)
    )


def codes(raw: DataFrame) -> DataFrame:
    return raw.select("mcc", "description", *_carried(raw, LINEAGE))


def to_landing_transactions(flat: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Flat source columns to the file contract: the merchant columns nested in one object."""
    return flat.select(
        "id", "date", "client_id", "card_id", "amount", "use_chip", "errors",
        F.struct(*MERCHANT_FIELDS).alias("merchant"),
        *(extra or []),
    )

