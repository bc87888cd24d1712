"""Column functions for the text formats of the sources. All of them turn bad text into NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.contracts import MERCHANT_FIELDS

MONEY = "decimal(12,2)"


def money(text: Column) -> Column:
    """``$-1.50`` to DECIMAL(12,2): every dollar sign goes, half-up, overflow is NULL."""
    return F.replace(text, F.lit("$"), F.lit("")).try_cast(MONEY)


def event_time(text: Column) -> Column:
    """Wall-clock time of the event. No zone is implied, so the session zone cannot shift it."""
    return text.try_cast("timestamp_ntz")


def zip5(text: Column) -> Column:
    """``523.0`` to ``00523``."""
    return F.lpad(F.split_part(text, F.lit("."), F.lit(1)), 5, "0")


def error_list(text: Column) -> Column:
    return F.split(text, ",")


def yes_no(text: Column) -> Column:
    return text.try_cast("boolean")


def month_start(text: Column) -> Column:
    """``02/2020`` to 2020-02-01."""
    return F.try_to_date(text, "MM/yyyy")


def month_end(text: Column) -> Column:
    """``02/2020`` to 2020-02-29."""
    return F.last_day(month_start(text))


def first_of_month(year: Column, month: Column) -> Column:
    """``make_date`` raises on month 13 under ANSI, so the range is checked first."""
    y, m = year.try_cast("int"), month.try_cast("int")
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def merchant_struct(text: Column) -> Column:
    """The merchant object, parsed once for all of its fields."""
    return F.from_json(text, ", ".join(f"{name} STRING" for name in MERCHANT_FIELDS))


def card_bin(pan: Column) -> Column:
    return F.substring(pan, 1, 6)


def card_last4(pan: Column) -> Column:
    return F.right(pan, F.lit(4))


def delivery_date(path: Column) -> Column:
    """Business date of a delivery, from ``date_partition=YYYY-MM-DD`` in its path."""
    return F.try_to_date(F.regexp_extract(path, r"date_partition=(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def digest(seed: str, *parts: Column) -> Column:
    """md5 of the seed and the parts; the same text on every run, engine and row order."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts]))


def draw(seed: str, modulus: int, *parts: Column) -> Column:
    """A stable number in 0..modulus-1 for the row."""
    hexed = F.substring(digest(seed, *parts), 1, 8)
    return F.conv(hexed, 16, 10).cast("bigint") % F.lit(modulus)
