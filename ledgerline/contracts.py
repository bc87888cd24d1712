"""Entity contracts: columns, allowed values and quality rules, as data."""

from __future__ import annotations

from dataclasses import dataclass


# File contracts of the five sources. Every landing and Bronze column is text.
TRANSACTION_COLUMNS = [
    "id", "date", "client_id", "card_id", "amount", "use_chip", "errors", "merchant",
]
TRANSACTION_LATE_COLUMN = "device_type"
MERCHANT_FIELDS = ["merchant_id", "merchant_city", "merchant_state", "zip", "mcc"]
CLIENT_COLUMNS = [
    "id", "name", "ssn", "email", "current_age", "retirement_age", "birth_year", "birth_month",
    "gender", "address", "latitude", "longitude", "per_capita_income", "yearly_income",
    "total_debt", "credit_score", "num_credit_cards",
]
CARD_COLUMNS = [
    "id", "client_id", "card_brand", "card_type", "card_number", "expires", "cvv", "has_chip",
    "num_cards_issued", "credit_limit", "acct_open_date", "year_pin_last_changed",
    "card_on_dark_web",
]

# Allowed texts.
CAPTURE_MODES = ["Online Transaction", "Swipe Transaction", "Chip Transaction"]
CARD_TYPES = ["Credit", "Debit", "Debit (Prepaid)"]
GENDERS = ["Male", "Female"]

# Lineage columns written with every Bronze row.
SOURCE_FILE = "source_file"
INGESTED_AT = "ingested_at"
RESCUED = "rescued_data"
LINEAGE = [SOURCE_FILE, INGESTED_AT]


@dataclass(frozen=True)
class Rule:
    """A row must make ``predicate`` true. Drop rules also carry a quarantine reason."""

    name: str
    predicate: str
    drop: bool = False
    reason: str | None = None
    rank: int = 99  # order in which reasons are tried


def _in(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


TRANSACTION_RULES = [
    Rule("id_present", "id IS NOT NULL", True, "id_null", 1),
    Rule("amount_present", "amount IS NOT NULL", True, "amount_null", 2),
    Rule("date_present", "event_ts IS NOT NULL", True, "date_null", 3),
    Rule("use_chip_valid", _in("use_chip", CAPTURE_MODES), True, "use_chip_invalid", 5),
    Rule("no_rescued_data", f"{RESCUED} IS NULL"),
    # a missing zip is right for online sales and for merchants abroad (long state names)
    Rule("zip_absence_justified",
         "merchant_zip IS NOT NULL OR use_chip = 'Online Transaction'"
         " OR coalesce(length(merchant_state), 0) > 2"),
    Rule("card_exists", "card_exists", True, "card_unknown", 4),
]
CLIENT_RULES = [
    Rule("id_present", "id IS NOT NULL", True, "id_null", 1),
    Rule("credit_score_range", "credit_score BETWEEN 300 AND 850"),
    Rule("gender_valid", _in("gender", GENDERS)),
    Rule("birth_date_present", "birth_date IS NOT NULL"),
    Rule("no_rescued_data", f"{RESCUED} IS NULL"),
]
CARD_RULES = [
    Rule("id_present", "id IS NOT NULL", True, "id_null", 1),
    Rule("card_type_valid", _in("card_type", CARD_TYPES)),
    Rule("expiry_valid", "expires_on IS NOT NULL"),
    Rule("opening_valid", "opened_on IS NOT NULL"),
]
LABEL_RULES = [
    Rule("transaction_id_present", "transaction_id IS NOT NULL", True, "transaction_id_null", 1),
    Rule("is_fraud_valid", "is_fraud IS NOT NULL"),
]
CODE_RULES = [
    Rule("mcc_present", "mcc IS NOT NULL", True, "mcc_null", 1),
]

# Columns whose change opens a new client version: all but lineage and rescued data.
CLIENT_TRACKED = [
    "name", "ssn", "email", "current_age", "retirement_age", "birth_date", "gender", "address",
    "latitude", "longitude", "per_capita_income", "yearly_income", "total_debt",
    "credit_score", "num_credit_cards",
]
