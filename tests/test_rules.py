from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerline import contracts as k
from ledgerline.operators import expectations
from ledgerline.plans import inputs

GOLDEN_DIR = "/root/testdata/sf0.01"
GOLDEN_REASONS = {
    "id_null": 4, "amount_null": 70, "date_null": 10, "card_unknown": 30, "use_chip_invalid": 425, "valid": 9561}
GOLDEN_VIOLATIONS = {
    "id_present": 4, "amount_present": 70, "date_present": 10, "card_exists": 31, "use_chip_valid": 425,
    "zip_absence_justified": 741, "no_rescued_data": 0}


def test_golden_counts(spark):
    typed = inputs.typed_transactions(spark, GOLDEN_DIR)
    reasons = typed.groupBy(
        F.coalesce(expectations.reason(k.TRANSACTION_RULES), F.lit("valid")).alias("r")).count().collect()
    assert {r.r: r["count"] for r in reasons} == GOLDEN_REASONS
    counts = {r.rule: r for r in expectations.rule_counts(typed, k.TRANSACTION_RULES).collect()}
    assert {n: r.failed for n, r in counts.items()} == GOLDEN_VIOLATIONS
    assert {r.passed + r.failed for r in counts.values()} == {10100}


def test_valid_and_quarantine_partition_the_input(spark):
    typed = inputs.typed_transactions(spark, "/root/testdata/sf0.001")
    kept = expectations.keep(typed, k.TRANSACTION_RULES)
    out = expectations.quarantine(typed, k.TRANSACTION_RULES)
    assert kept.count() + out.count() == typed.count()
    assert kept.select(*inputs.RAW_KEYS).intersect(out.select(*inputs.RAW_KEYS)).count() == 0


def tx(spark, **changes):
    row = dict(id="1", amount=1.0, event_ts="2020-01-01", use_chip="Chip Transaction", rescued_data=None,
               merchant_zip="00001", merchant_state="CA", card_exists=True)
    row.update(changes)
    types = {"amount": "DOUBLE", "card_exists": "BOOLEAN"}
    schema = ", ".join(f"{c} {types.get(c, 'STRING')}" for c in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_first_reason_wins_and_null_is_a_violation(spark):
    def why(**c):
        return tx(spark, **c).select(expectations.reason(k.TRANSACTION_RULES)).first()[0]

    assert why() is None
    assert why(id=None, amount=None) == "id_null"
    assert why(amount=None, event_ts=None) == "amount_null"
    assert why(event_ts=None, card_exists=False) == "date_null"
    assert why(card_exists=False, use_chip="x") == "card_unknown"
    assert why(card_exists=None) == "card_unknown"
    assert why(use_chip=None) == "use_chip_invalid"
    assert why(use_chip="x") == "use_chip_invalid"


def test_zip_warning(spark):
    def warned(**c):
        return expectations.warn(tx(spark, **c), k.TRANSACTION_RULES).first().warnings

    assert warned(merchant_zip=None) == ["zip_absence_justified"]
    assert warned(merchant_zip=None, merchant_state="Italy") == []
    assert warned(merchant_zip=None, use_chip="Online Transaction") == []
    assert warned(merchant_zip=None, merchant_state=None) == ["zip_absence_justified"]
    assert warned(rescued_data="{}") == ["no_rescued_data"]


def test_counters_of_a_write_equal_those_of_a_query(spark, root):
    typed = inputs.typed_transactions(spark, "/root/testdata/sf0.001")
    seen = Observation()
    expectations.observe(typed, k.TRANSACTION_RULES, seen).write.parquet(root)
    asked = {r.rule: (r.passed, r.failed) for r in expectations.rule_counts(typed, k.TRANSACTION_RULES).collect()}
    assert {n: (p, f) for n, p, f in expectations.observed_counts(k.TRANSACTION_RULES, seen)} == asked


def test_rule_inventory():
    sets = [k.TRANSACTION_RULES, k.CLIENT_RULES, k.CARD_RULES, k.LABEL_RULES, k.CODE_RULES]
    rules = [r for s in sets for r in s]
    assert (len(rules), sum(r.drop for r in rules)) == (19, 9)
