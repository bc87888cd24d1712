"""The registered queries once more as SQL for DuckDB, written from the definitions."""

from __future__ import annotations

RAW = """raw AS (
  SELECT event_id, seq,
    CASE WHEN event_id % 2500 <> 9 THEN CAST(event_id AS VARCHAR) END AS id,
    CASE WHEN event_id % 1000 = 17 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date,
    CAST(user_id AS VARCHAR) AS client_id,
    CAST(CASE WHEN event_id % 333 = 5 THEN 900000 + event_id ELSE user_id END AS VARCHAR) AS card_id,
    CASE WHEN event_id % 200 = 7 THEN NULL WHEN event_id % 500 = 3 THEN 'abc'
         WHEN event_id % 20 = 1 THEN '$-' || v ELSE '$' || v END AS amount,
    CASE WHEN event_type IN ('click', 'signup') THEN 'Online Transaction'
         WHEN event_type = 'view' THEN 'Swipe Transaction'
         WHEN event_type = 'purchase' THEN 'Chip Transaction'
         WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 = 1 THEN 'Unknown'
         ELSE 'Swipe Transaction' END AS use_chip,
    CASE WHEN event_id % 50 = 0 THEN 'Bad PIN,Insufficient Balance'
         WHEN event_id % 50 = 1 THEN 'Bad PIN' END AS errors,
    CAST(user_id AS VARCHAR) AS merchant_id,
    'City ' || CAST(user_id % 10 AS VARCHAR) AS merchant_city,
    CASE WHEN event_id % 8 = 0 THEN 'Italy' ELSE 'CA' END AS merchant_state,
    CASE WHEN event_id % 4 <> 0 THEN CAST(500 + event_id AS VARCHAR) || '.0' END AS zip,
    CAST(5000 + event_id % 25 AS VARCHAR) AS mcc,
    CAST(ts AS DATE) AS event_date,
    CAST(CAST(ts AS DATE) + CAST((CASE WHEN seq = 2 THEN 2 ELSE 0 END)
      + (CASE WHEN event_id % 50 = 3 THEN 1 + event_id % 7 ELSE 0 END) AS INTEGER) AS DATE) AS delivery_date
  FROM (
    SELECT *, 0 AS seq, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS v FROM events
    UNION ALL SELECT *, 1, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) FROM events WHERE event_id % 200 = 11
    UNION ALL SELECT *, 2, CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) FROM events WHERE event_id % 200 = 23
  )
)"""

TYPED = RAW + """, typed AS (
  SELECT r.event_id, r.seq, r.event_date, r.delivery_date, r.id,
    TRY_CAST(r.date AS TIMESTAMP) AS event_ts, r.client_id, r.card_id,
    TRY_CAST(replace(r.amount, '$', '') AS DECIMAL(12,2)) AS amount,
    TRY_CAST(replace(r.amount, '$', '') AS DECIMAL(12,2)) < 0 AS is_refund,
    r.use_chip, r.merchant_id, r.merchant_city, r.merchant_state,
    CASE WHEN length(split_part(r.zip, '.', 1)) >= 5 THEN substr(split_part(r.zip, '.', 1), 1, 5)
         ELSE lpad(split_part(r.zip, '.', 1), 5, '0') END AS merchant_zip,
    r.mcc AS merchant_mcc, replace(r.errors, ',', '|') AS errors,
    c.c_custkey IS NOT NULL AS card_exists
  FROM raw r LEFT JOIN customer c ON r.card_id = CAST(c.c_custkey AS VARCHAR)
), judged AS (
  SELECT *, CASE
    WHEN id IS NULL THEN 'id_null'
    WHEN amount IS NULL THEN 'amount_null'
    WHEN event_ts IS NULL THEN 'date_null'
    WHEN NOT card_exists THEN 'card_unknown'
    WHEN use_chip IS NULL OR use_chip NOT IN ('Online Transaction', 'Swipe Transaction', 'Chip Transaction')
      THEN 'use_chip_invalid' END AS reason
  FROM typed
), valid AS (SELECT * FROM judged WHERE reason IS NULL),
current_tx AS (
  SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY id ORDER BY delivery_date DESC, seq DESC) = 1
), tx_rules AS (
  SELECT *, id IS NOT NULL AS r1, amount IS NOT NULL AS r2, event_ts IS NOT NULL AS r3,
    coalesce(use_chip IN ('Online Transaction', 'Swipe Transaction', 'Chip Transaction'), false) AS r4,
    true AS r5,
    coalesce(merchant_zip IS NOT NULL OR use_chip = 'Online Transaction'
      OR coalesce(length(merchant_state), 0) > 2, false) AS r6,
    card_exists AS r7
  FROM typed
)"""

CLIENTS = """raw_clients AS (
  SELECT c_custkey AS n, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '000-00-0000' AS ssn,
    'client' || c_custkey || '@example.com' AS email,
    CAST(18 + c_custkey % 70 AS INTEGER) AS current_age,
    CASE WHEN c_custkey % 101 <> 0 THEN CAST(60 + c_custkey % 10 AS INTEGER) END AS retirement_age,
    CASE WHEN 1 + c_custkey % 13 <= 12 THEN
      make_date(CAST(1950 + c_custkey % 50 AS INTEGER), CAST(1 + c_custkey % 13 AS INTEGER), 1) END AS birth_date,
    CASE WHEN c_custkey % 3 = 0 THEN 'Male' WHEN c_custkey % 3 = 1 THEN 'Female'
         WHEN c_custkey % 5 = 0 THEN 'X' END AS gender,
    CAST(100 + c_custkey % 900 AS VARCHAR) || ' ' || c_mktsegment || ' St, Apt 4' AS address,
    20 + c_custkey % 50 + CAST(0.25 AS DOUBLE) AS latitude,
    -(70 + c_custkey % 50 + CAST(0.5 AS DOUBLE)) AS longitude,
    abs(CAST(c_acctbal AS DECIMAL(12,2))) AS per_capita_income,
    CAST((c_custkey % 1000) * 100 AS DECIMAL(12,2)) AS yearly_income,
    CASE WHEN c_custkey % 97 <> 0 THEN -abs(CAST(c_acctbal AS DECIMAL(12,2))) END AS total_debt,
    CAST(250 + c_custkey % 650 AS INTEGER) AS credit_score,
    c_nationkey AS num_credit_cards, c_mktsegment, c_acctbal
  FROM customer
)"""

CARDS = """raw_cards AS (
  SELECT p_partkey AS n, CAST(p_partkey AS VARCHAR) AS id, CAST(p_partkey % 1500 AS VARCHAR) AS client_id,
    p_brand AS card_brand,
    CASE p_partkey % 4 WHEN 0 THEN 'Credit' WHEN 1 THEN 'Debit' WHEN 2 THEN 'Debit (Prepaid)' ELSE p_type END AS card_type,
    '4' || lpad(CAST(p_partkey AS VARCHAR), 15, '3') AS card_number,
    CASE WHEN p_partkey % 97 = 0 THEN '13/2020' ELSE lpad(CAST(1 + p_partkey % 12 AS VARCHAR), 2, '0')
      || '/' || CAST(2017 + p_partkey % 6 AS VARCHAR) END AS expires,
    CASE WHEN p_partkey % 2 = 0 THEN 'YES' ELSE 'NO' END AS has_chip,
    CAST(1 + p_partkey % 3 AS VARCHAR) AS num_cards_issued,
    '$' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS credit_limit,
    CASE WHEN p_partkey % 89 = 0 THEN '00/2001' ELSE lpad(CAST(1 + p_partkey % 12 AS VARCHAR), 2, '0')
      || '/' || CAST(1999 + p_partkey % 15 AS VARCHAR) END AS acct_open_date,
    CAST(2002 + p_partkey % 18 AS VARCHAR) AS year_pin_last_changed,
    CASE p_partkey % 50 WHEN 0 THEN 'Yes' WHEN 1 THEN 'maybe' ELSE 'No' END AS card_on_dark_web
  FROM part
), typed_cards AS (
  SELECT n, id, client_id, card_brand, card_type,
    CAST(last_day(CAST(try_strptime(expires, '%m/%Y') AS DATE)) AS DATE) AS expires_on,
    TRY_CAST(has_chip AS BOOLEAN) AS has_chip, CAST(num_cards_issued AS INTEGER) AS num_cards_issued,
    CAST(replace(credit_limit, '$', '') AS DECIMAL(12,2)) AS credit_limit,
    CAST(try_strptime(acct_open_date, '%m/%Y') AS DATE) AS opened_on,
    CAST(year_pin_last_changed AS INTEGER) AS pin_changed_year,
    TRY_CAST(card_on_dark_web AS BOOLEAN) AS on_dark_web,
    substr(card_number, 1, 6) AS card_bin, right(card_number, 4) AS card_last4
  FROM raw_cards
)"""

CLIENT_VERSIONS = CLIENTS + """, client_versions AS (
  SELECT * EXCLUDE (n, c_mktsegment, c_acctbal), TIMESTAMP '2024-01-01' AS valid_from,
    CASE WHEN yearly_income <> 64200 THEN TIMESTAMP '2024-01-20' END AS valid_to,
    yearly_income = 64200 AS is_current FROM raw_clients
  UNION ALL
  SELECT * EXCLUDE (n, c_mktsegment, c_acctbal) REPLACE (CAST(64200 AS DECIMAL(12,2)) AS yearly_income),
    TIMESTAMP '2024-01-20', NULL, true FROM raw_clients WHERE yearly_income <> 64200
)"""

LABELS = """lab AS (
  SELECT CAST(doc_id AS VARCHAR) AS transaction_id, toxic = 1 AS is_fraud FROM labels
)"""

CODES = """codes AS (
  SELECT 'N' || p_partkey AS mcc, p_name AS description FROM part
  UNION ALL SELECT 'T' || p_partkey, p_type FROM part
)"""

VERSIONS = """versions AS (
  SELECT *, o_orderdate AS valid_from,
    lead(o_orderdate) OVER w AS valid_to, lead(o_orderkey) OVER w IS NULL AS is_current
  FROM (
    SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before_,
      row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders
  ) WHERE rn = 1 OR before_ IS DISTINCT FROM o_orderstatus
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
)"""

UNTIMED = """log AS (
  SELECT * REPLACE (CASE WHEN o_orderkey % 29 <> 0 THEN o_orderdate END AS o_orderdate) FROM orders
), versions AS (
  SELECT *, o_orderdate AS valid_from,
    lead(o_orderdate) OVER w AS valid_to, lead(o_orderkey) OVER w IS NULL AS is_current
  FROM (
    SELECT *, lag(o_orderstatus) OVER x AS before_, row_number() OVER x AS rn FROM log
    WINDOW x AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey)
  ) WHERE rn = 1 OR before_ IS DISTINCT FROM o_orderstatus
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate NULLS FIRST, o_orderkey)
)"""

FILES = RAW + """, files AS (
  SELECT id, event_date, delivery_date,
    'landing/transactions/daily/date_partition=' || CAST(delivery_date AS VARCHAR) || '/part.json' AS source_file,
    count(*) AS n_copies, bool_or(amount IS NULL) AS null_amount,
    bool_or(NOT EXISTS (SELECT 1 FROM customer c WHERE CAST(c.c_custkey AS VARCHAR) = raw.card_id)) AS unknown_card,
    bool_or(event_date >= DATE '2024-01-16') AS has_new_column
  FROM raw WHERE id IS NOT NULL GROUP BY ALL
), classes AS (
  SELECT f.*, EXISTS (SELECT 1 FROM files g WHERE g.id = f.id
      AND f.delivery_date - g.delivery_date BETWEEN 1 AND 7) AS is_resent
  FROM files f
), classified AS (
  SELECT *, n_copies > 1 AS in_file_duplicate,
    CAST(CASE WHEN is_resent THEN 0 ELSE greatest(delivery_date - event_date, 0) END AS INTEGER) AS days_late
  FROM classes
), days AS (
  SELECT id, delivery_date, count(*) AS n_rows,
    lag(delivery_date) OVER (PARTITION BY id ORDER BY delivery_date) AS previous_delivery
  FROM raw WHERE id IS NOT NULL GROUP BY id, delivery_date
), marked AS (
  SELECT *, coalesce(delivery_date - previous_delivery BETWEEN 1 AND 7, false) AS is_resent FROM days
)"""


def _rules(source: str, rules: list[tuple[str, str]], by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{name}' AS rule, count(*) FILTER (WHERE coalesce({test}, false)) AS passed,"
        f" count(*) FILTER (WHERE NOT coalesce({test}, false)) AS failed FROM {source}{group}"
        for name, test in rules)


TX_RULES = [
    ("id_present", "r1"), ("amount_present", "r2"), ("date_present", "r3"), ("use_chip_valid", "r4"),
    ("no_rescued_data", "r5"), ("zip_absence_justified", "r6"), ("card_exists", "r7"),
]


def _draw(seed: str, modulus: int, key: str) -> str:
    return f"(CAST('0x' || substr(md5('{seed}|' || {key}), 1, 8) AS BIGINT) % {modulus})"


DEVICE = (f"CASE WHEN use_chip = 'Online Transaction' THEN CASE WHEN {_draw('device', 2, 'event_id')} = 0"
          " THEN 'mobile' ELSE 'web' END ELSE 'pos' END")

ORDERS_DAY = "SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders"


def _volumes(select: str, group: str, rest: str) -> str:
    return f"WITH {TYPED} SELECT {select}, count(*) AS n_rows, {rest} FROM current_tx GROUP BY {group}"


SQL = {
    "typed_transactions": f"WITH {TYPED} SELECT * FROM typed",
    "money_parse": f"WITH {TYPED} SELECT event_id, seq, amount, is_refund FROM typed",
    "zip_normalize": f"WITH {TYPED} SELECT event_id, seq, zip, merchant_zip FROM typed JOIN raw USING (event_id, seq)",
    "errors_split": f"""WITH {RAW} SELECT event_id, seq, len(string_split(errors, ',')) AS n_errors,
        string_split(errors, ',')[1] AS first_error, string_split(errors, ',')[2] AS second_error FROM raw""",
    "json_path_extract": f"WITH {RAW} SELECT event_id, seq, merchant_id, merchant_city, merchant_state, zip, mcc FROM raw",
    "nest_struct": f"WITH {RAW} SELECT event_id, seq, id, merchant_id, merchant_city, merchant_state, zip, mcc FROM raw",
    "typed_clients": f"WITH {CLIENTS} SELECT * EXCLUDE (n, c_mktsegment, c_acctbal) FROM raw_clients",
    "birth_date": f"WITH {CLIENTS} SELECT id, birth_date FROM raw_clients",
    "typed_cards": f"WITH {CARDS} SELECT * EXCLUDE (n) FROM typed_cards",
    "card_dates": f"WITH {CARDS} SELECT id, expires_on, opened_on FROM typed_cards",
    "pan_truncate": f"""WITH {CARDS} SELECT * EXCLUDE (n, card_number), substr(card_number, 1, 6) AS card_bin,
        right(card_number, 4) AS card_last4 FROM raw_cards""",
    "typed_labels": f"WITH {LABELS} SELECT * FROM lab",
    "typed_codes": f"WITH {CODES} SELECT * FROM codes",
    "card_lookup": f"WITH {TYPED} SELECT event_id, seq, card_id, card_exists FROM typed",
    "orphans_labels": """SELECT doc_id AS orphan_key, count(*) AS n_rows FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
    "orphans_lineitem": """SELECT l_orderkey AS orphan_key, count(*) AS n_rows FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey""",
    "orphans_events": """SELECT user_id AS orphan_key, count(*) AS n_rows FROM events
        WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY user_id""",
    "orphans_label_transactions": f"""WITH {TYPED} SELECT CAST(doc_id AS VARCHAR) AS orphan_key, count(*) AS n_rows FROM labels
        WHERE CAST(doc_id AS VARCHAR) NOT IN (SELECT id FROM current_tx) GROUP BY 1""",
    "orphans_card_clients": """SELECT CAST(p_partkey % 1500 AS VARCHAR) AS orphan_key, count(*) AS n_rows FROM part
        WHERE p_partkey % 1500 NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1""",
    "label_coverage_by_year": f"""WITH {RAW}, {LABELS} SELECT substr(r.date, 1, 4) AS grp, count(*) AS n_rows,
        count(l.is_fraud) AS n_labelled, count(*) FILTER (WHERE l.is_fraud) AS n_positive
        FROM raw r LEFT JOIN lab l ON r.id = l.transaction_id GROUP BY 1""",
    "orphans_cards": f"""WITH {TYPED} SELECT card_id AS orphan_key, count(*) AS n_rows FROM typed
        WHERE NOT card_exists GROUP BY card_id""",
    "orphans_codes": f"""WITH {RAW} SELECT mcc AS orphan_key, count(*) AS n_rows FROM raw
        WHERE mcc NOT IN (SELECT CAST(p_partkey + 5003 AS VARCHAR) FROM part) GROUP BY mcc""",
    "enrich_left": """SELECT c.*, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "label_tristate": f"""WITH {LABELS} SELECT CAST(d.doc_id AS VARCHAR) AS id, d.lang, l.is_fraud AS fraud_flag
        FROM documents d LEFT JOIN lab l ON CAST(d.doc_id AS VARCHAR) = l.transaction_id""",
    "label_coverage": f"""WITH {LABELS} SELECT d.lang AS grp, count(*) AS n_rows, count(l.is_fraud) AS n_labelled,
        count(*) FILTER (WHERE l.is_fraud) AS n_positive
        FROM documents d LEFT JOIN lab l ON CAST(d.doc_id AS VARCHAR) = l.transaction_id GROUP BY d.lang""",
    "fraud_rate": f"""WITH {LABELS} SELECT d.lang, count(*) AS n_rows, count(l.is_fraud) AS n_evaluated,
        count(*) FILTER (WHERE l.is_fraud) AS n_fraud, avg(CAST(l.is_fraud AS INTEGER)) AS fraud_rate
        FROM documents d LEFT JOIN lab l ON CAST(d.doc_id AS VARCHAR) = l.transaction_id GROUP BY d.lang""",
    "refund_pairs": f"""WITH {TYPED}, grouped AS (SELECT merchant_state, abs(amount) AS abs_amount,
          count(*) FILTER (WHERE amount > 0) AS n_purchases, count(*) FILTER (WHERE amount < 0) AS n_refunds
          FROM typed WHERE amount <> 0 GROUP BY ALL)
        SELECT *, least(n_purchases, n_refunds) AS n_pairs FROM grouped WHERE n_purchases > 0 AND n_refunds > 0""",
    "fact_asof_dim": f"""WITH {VERSIONS} SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice,
        v.o_orderstatus AS status_then, v.o_orderkey AS version_key
        FROM orders o LEFT JOIN versions v ON o.o_custkey = v.o_custkey AND v.valid_from <= o.o_orderdate
          AND (v.valid_to IS NULL OR o.o_orderdate < v.valid_to)""",
    "resent_duplicates": f"WITH {FILES} SELECT id, delivery_date, n_rows, previous_delivery FROM marked WHERE is_resent",
    "expect_drop_tx": f"WITH {TYPED} SELECT event_id, seq, id, amount, event_ts, card_id, use_chip FROM valid",
    "expect_warn_tx": f"""WITH {TYPED} SELECT event_id, seq, CASE WHEN r6 THEN '' ELSE 'zip_absence_justified' END AS warnings
        FROM tx_rules WHERE r1 AND r2 AND r3 AND r4 AND r7""",
    "rule_counts": f"WITH {TYPED} " + _rules("tx_rules", TX_RULES),
    "rule_counts_clients": f"WITH {CLIENTS} " + _rules("raw_clients", [
        ("id_present", "id IS NOT NULL"), ("credit_score_range", "credit_score BETWEEN 300 AND 850"),
        ("gender_valid", "gender IN ('Male', 'Female')"), ("birth_date_present", "birth_date IS NOT NULL"),
        ("no_rescued_data", "true")]),
    "rule_counts_cards": f"WITH {CARDS} " + _rules("typed_cards", [
        ("id_present", "id IS NOT NULL"), ("card_type_valid", "card_type IN ('Credit', 'Debit', 'Debit (Prepaid)')"),
        ("expiry_valid", "expires_on IS NOT NULL"), ("opening_valid", "opened_on IS NOT NULL")]),
    "rule_counts_labels": f"WITH {LABELS} " + _rules("lab", [
        ("transaction_id_present", "transaction_id IS NOT NULL"), ("is_fraud_valid", "is_fraud IS NOT NULL")]),
    "quarantine_tx": f"""WITH {TYPED} SELECT event_id, seq, id, amount, event_ts, card_id, use_chip, card_exists, reason
        FROM judged WHERE reason IS NOT NULL""",
    "valid_plus_quarantine": f"WITH {TYPED} SELECT coalesce(reason, 'valid') AS side, count(*) AS n_rows FROM judged GROUP BY 1",
    "quality_metrics": f"""WITH {TYPED}, runs AS (
          SELECT *, 'run-' || CAST(day(delivery_date) % 2 AS VARCHAR) AS run_id FROM tx_rules),
        lines AS ({_rules("runs", TX_RULES, "run_id")})
        SELECT run_id, 'transactions' AS table_name, rule, TIMESTAMP '2024-02-01 00:00:00' AS measured_at,
          passed, failed, round(100.0 * CAST(failed AS DOUBLE) / nullif(passed + failed, 0), 4) AS pct_failed
        FROM lines""",
    "reconcile_answer_key": f"""WITH {FILES}, expected AS (
          SELECT DISTINCT kind, CAST(event_id AS VARCHAR) AS id FROM (
            SELECT event_id, 'null_amount' AS kind FROM events WHERE event_id % 200 = 7
            UNION ALL SELECT event_id, 'unknown_card' FROM events WHERE event_id % 333 = 5
            UNION ALL SELECT event_id, 'in_file_duplicate' FROM events WHERE event_id % 200 = 11
            UNION ALL SELECT event_id, 'resent' FROM events WHERE event_id % 200 = 23
            UNION ALL SELECT event_id, 'late' FROM events WHERE event_id % 50 = 3
          ) WHERE event_id % 2500 <> 9),
        found AS (
          SELECT DISTINCT 'null_amount' AS kind, id FROM classified WHERE null_amount
          UNION SELECT 'unknown_card', id FROM classified WHERE unknown_card
          UNION SELECT 'in_file_duplicate', id FROM classified WHERE in_file_duplicate
          UNION SELECT 'resent', id FROM classified WHERE is_resent
          UNION SELECT 'late', id FROM classified WHERE days_late > 0)
        SELECT coalesce(e.kind, f.kind) AS kind, count(e.id) AS n_expected, count(f.id) AS n_found,
          count(*) FILTER (WHERE f.id IS NULL) AS n_missing, count(*) FILTER (WHERE e.id IS NULL) AS n_extra
        FROM expected e FULL JOIN found f ON e.kind = f.kind AND e.id = f.id GROUP BY 1""",
    "reconcile_quarantine": f"""WITH {TYPED}, expected AS (
          SELECT 'amount_null' AS kind, CAST(event_id AS VARCHAR) AS id FROM events
            WHERE event_id % 2500 <> 9 AND event_id % 200 = 7
          UNION ALL SELECT 'card_unknown', CAST(event_id AS VARCHAR) FROM events
            WHERE event_id % 2500 <> 9 AND event_id % 333 = 5),
        found AS (SELECT DISTINCT reason AS kind, id FROM judged WHERE reason IN ('amount_null', 'card_unknown'))
        SELECT coalesce(e.kind, f.kind) AS kind, count(e.id) AS n_expected, count(f.id) AS n_found,
          count(*) FILTER (WHERE f.id IS NULL) AS n_missing, count(*) FILTER (WHERE e.id IS NULL) AS n_extra
        FROM expected e FULL JOIN found f ON e.kind = f.kind AND e.id = f.id GROUP BY 1""",
    "classify_deliveries": f"WITH {FILES} SELECT *, days_late > 0 AS is_late FROM classified",
    "late_matrix": f"""WITH {RAW} SELECT event_date, delivery_date, count(*) AS n_rows,
        CAST(delivery_date - event_date AS INTEGER) AS delay_days FROM raw GROUP BY event_date, delivery_date""",
    "late_movement": f"""WITH {RAW}, legs AS (
          SELECT delivery_date AS day, 1 AS o, 0 AS l, 0 AS a FROM raw WHERE delivery_date = event_date
          UNION ALL SELECT event_date, 0, 1, 0 FROM raw WHERE delivery_date <> event_date
          UNION ALL SELECT delivery_date, 0, 0, 1 FROM raw WHERE delivery_date <> event_date)
        SELECT day, CAST(sum(o) AS BIGINT) AS n_on_time, CAST(sum(l) AS BIGINT) AS n_left_late,
          CAST(sum(a) AS BIGINT) AS n_arrived_late, CAST(sum(o + a) AS BIGINT) AS n_delivered
        FROM legs GROUP BY day""",
    "delivery_conservation": f"""WITH {FILES}, per_id AS (
          SELECT id, count(*) FILTER (WHERE NOT is_resent) AS n_deliveries FROM marked GROUP BY id)
        SELECT n_deliveries, count(*) AS n_ids FROM per_id GROUP BY n_deliveries""",
    "scd1_transactions": f"WITH {TYPED} SELECT id, seq, delivery_date, event_ts, amount, card_id, use_chip FROM current_tx",
    "scd1_cards": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
          l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
    "scd2_clients": f"WITH {VERSIONS} SELECT * EXCLUDE (before_, rn) FROM versions",
    "scd2_split": f"WITH {UNTIMED} SELECT * EXCLUDE (before_, rn) FROM versions",
    "asof_split": f"""WITH {UNTIMED} SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice,
        v.o_orderstatus AS status_then, v.o_orderkey AS version_key
        FROM log o LEFT JOIN versions v ON o.o_custkey = v.o_custkey AND v.valid_from <= o.o_orderdate
          AND (v.valid_to IS NULL OR o.o_orderdate < v.valid_to)""",
    "scd2_current": f"WITH {VERSIONS} SELECT * EXCLUDE (before_, rn, valid_to, is_current) FROM versions WHERE is_current",
    "state_as_of": """SELECT *, o_orderdate = TIMESTAMP '1998-01-01' AS changed_today FROM orders
        WHERE o_orderdate <= TIMESTAMP '1998-01-01'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
    "key_profile": f"""WITH {RAW} SELECT count(*) AS n_rows, count(DISTINCT id) AS n_distinct,
        count(*) - count(id) AS n_null, count(*) = count(DISTINCT id) AS is_unique FROM raw""",
    "key_profile_lineitem": """WITH l AS (SELECT l_orderkey || '-' || l_linenumber AS k FROM lineitem)
        SELECT count(*) AS n_rows, count(DISTINCT k) AS n_distinct, count(*) - count(k) AS n_null,
          count(*) = count(DISTINCT k) AS is_unique FROM l""",
    "time_extent": f"WITH {RAW} SELECT min(date) AS min_value, max(date) AS max_value FROM raw",
    "count_by_capture_mode": f"WITH {RAW} SELECT use_chip, count(*) AS n_rows FROM raw GROUP BY use_chip",
    "count_by_errors": f"WITH {RAW} SELECT errors, count(*) AS n_rows FROM raw GROUP BY errors",
    "count_by_source_file": f"""WITH {RAW} SELECT 'landing/transactions/daily/date_partition='
        || CAST(delivery_date AS VARCHAR) || '/part.json' AS source_file, count(*) AS n_rows FROM raw GROUP BY 1""",
    "numeric_key_sort": f"WITH {RAW} SELECT id, TRY_CAST(id AS BIGINT) AS key_number, seq FROM raw",
    "period_split": f"""SELECT substr(day, 1, 4) AS year, count(*) AS n_rows,
        CASE WHEN day < '1997-01-01' THEN 'backfill' ELSE 'daily' END AS side FROM ({ORDERS_DAY}) GROUP BY 1, 3""",
    "split_reconcile": f"""SELECT count(*) AS n_total, count(*) FILTER (WHERE day < '1997-01-01') AS n_before,
        count(*) FILTER (WHERE day >= '1997-01-01') AS n_after, true AS is_complete FROM ({ORDERS_DAY})""",
    "volume_gross_net": _volumes("use_chip", "use_chip", """
        CAST(coalesce(sum(amount) FILTER (WHERE NOT is_refund), 0) AS DECIMAL(18,2)) AS gross,
        CAST(coalesce(sum(-amount) FILTER (WHERE is_refund), 0) AS DECIMAL(18,2)) AS refunds,
        CAST(sum(amount) AS DECIMAL(18,2)) AS net,
        round(CAST(sum(amount) FILTER (WHERE NOT is_refund) AS DOUBLE)
          / count(*) FILTER (WHERE NOT is_refund), 4) AS avg_ticket"""),
    "monthly_volume": _volumes(
        "strftime(event_ts, '%Y-%m') AS month, CASE WHEN errors IS NULL THEN 'approved' ELSE 'declined' END AS status",
        "1, 2", "CAST(sum(amount) AS DECIMAL(18,2)) AS net"),
    "errors_by_type": f"""WITH {RAW} SELECT error_type, count(*) AS n_errors
        FROM (SELECT unnest(string_split(errors, ',')) AS error_type FROM raw) GROUP BY error_type""",
    "fact_transactions": f"""WITH {TYPED}, {LABELS} SELECT t.id, event_ts, card_id, client_id, amount, is_refund, merchant_mcc,
        CASE WHEN errors IS NULL THEN 'approved' ELSE 'declined' END AS status, l.is_fraud AS fraud_flag
        FROM current_tx t LEFT JOIN lab l ON t.id = l.transaction_id""",
    "dim_category": f"WITH {CODES} SELECT * FROM codes",
    "sample_exact_rate": """WITH ranked AS (
          SELECT event_id, CAST(ts AS DATE) AS event_date, event_type,
            row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY md5('A|' || event_id)) AS rn,
            count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS n FROM events)
        SELECT event_id, event_date, event_type FROM ranked WHERE rn <= round_even(n * 0.02, 0)""",
    "weighted_bucket": f"""WITH d AS (SELECT c_custkey, {_draw('split', 100, 'c_custkey')} AS x FROM customer)
        SELECT c_custkey, CASE WHEN x < 80 THEN 'train' WHEN x < 95 THEN 'tune' ELSE 'test' END AS part FROM d""",
    "device_type": f"WITH {RAW} SELECT event_id, seq, {DEVICE} AS device_type FROM raw",
    "pseudonymize": f"""WITH {CLIENTS}, t AS (SELECT id, gender, substr(sha256('s3|' || id), 1, 16) AS token FROM raw_clients)
        SELECT id, 'person-' || token AS name, CAST(NULL AS VARCHAR) AS ssn, token || '@pseudonym.invalid' AS email, gender FROM t""",
    "map_whole_labels": f"""WITH {LABELS} SELECT transaction_id, CASE WHEN is_fraud THEN 'Yes' ELSE 'No' END AS is_fraud FROM lab""",
    "state_as_of_sparse": """SELECT o_custkey,
        last(o_orderstatus ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_orderkey % 3 = 0 AND o_orderstatus IS NOT NULL) AS o_orderstatus,
        last(o_orderpriority ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_orderkey % 3 = 1 AND o_orderpriority IS NOT NULL) AS o_orderpriority,
        last(o_totalprice ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_orderkey % 3 = 2 AND o_totalprice IS NOT NULL) AS o_totalprice,
        max(o_orderdate = TIMESTAMP '1998-01-01') AS changed_today FROM orders WHERE o_orderdate <= TIMESTAMP '1998-01-01' GROUP BY o_custkey""",
    "load_by_variables": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1997-02-01'",
    "map_any_text": r"""SELECT CASE WHEN c_custkey % 5 = 0 THEN ':,' ELSE '' END || c_custkey AS mcc,
        CASE c_custkey % 3 WHEN 0 THEN c_name || ', "' || c_mktsegment || '": {"a,": "}"}, \, x' || chr(10) || ',y'
          WHEN 1 THEN ',' ELSE c_name END AS description FROM customer""",
    "unpivot_wide_object": """SELECT 'N' || n_nationkey AS mcc,
        s.c_mktsegment || ':' || (SELECT count(*) FROM customer c WHERE c.c_mktsegment = s.c_mktsegment AND c.c_nationkey = n_nationkey)
          AS description FROM nation, (SELECT DISTINCT c_mktsegment FROM customer) s""",
    "table_file_stats": "SELECT count(*) AS n_rows, true AS has_files, true AS has_bytes FROM orders",
    "map_explode_labels": f"""WITH {LABELS} SELECT transaction_id, CASE WHEN is_fraud THEN 'Yes' ELSE 'No' END AS is_fraud FROM lab""",
    "map_explode_codes": f"WITH {CODES} SELECT * FROM codes",
    "unpivot_codes": """SELECT p_partkey, 'p_name' AS attribute, p_name AS description FROM part
        UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part UNION ALL SELECT p_partkey, 'p_type', p_type FROM part""",
    "json_null_fields": f"WITH {RAW} SELECT event_id, seq, true AS has_amount_key, amount IS NULL AS is_null FROM raw",
    "partition_pruned_scan": """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-01-20' AND o_orderdate < TIMESTAMP '1997-02-04'""",
    "dynamic_overwrite": """SELECT o_orderkey, o_custkey, CASE WHEN strftime(o_orderdate, '%Y-%m') = '1997-01' THEN 'R'
        ELSE o_orderstatus END AS o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month_year FROM orders""",
    "union_backfill_daily": f"""WITH {RAW} SELECT event_id, seq, id, amount, CASE WHEN delivery_date >= DATE '2024-01-16'
        AND event_date >= DATE '2024-01-16' THEN {DEVICE} END AS device_type FROM raw""",
    "snapshot_reload": f"WITH {CODES} SELECT mcc, upper(description) AS description FROM codes",
    "bronze_tx_stream": f"""WITH {RAW} SELECT id, date, client_id, card_id, amount, use_chip, errors,
        merchant_id, merchant_city, merchant_state, zip, mcc FROM raw""",
    "bronze_clients_stream": f"""WITH {CLIENTS}, text AS (SELECT id, name, ssn, email, CAST(current_age AS VARCHAR) AS current_age,
          coalesce(CAST(retirement_age AS VARCHAR), 'soon') AS retirement_age,
          CAST(1950 + n % 50 AS VARCHAR) AS birth_year, CAST(1 + n % 13 AS VARCHAR) AS birth_month, gender, address,
          CAST(20 + n % 50 AS VARCHAR) || '.25' AS latitude, '-' || CAST(70 + n % 50 AS VARCHAR) || '.5' AS longitude,
          '$' || CAST(per_capita_income AS VARCHAR) AS per_capita_income,
          CAST((n % 1000) * 100 AS VARCHAR) AS income, CASE WHEN n % 97 <> 0 THEN '$-' || CAST(per_capita_income AS VARCHAR) END AS total_debt,
          CAST(credit_score AS VARCHAR) AS credit_score, CAST(num_credit_cards AS VARCHAR) AS num_credit_cards
          FROM raw_clients)
        SELECT * EXCLUDE (income), '$' || income AS yearly_income FROM text
        UNION ALL SELECT * EXCLUDE (income), '$9' || income FROM text""",
    "bronze_cards_load": f"""WITH {CARDS} SELECT * EXCLUDE (n, card_number), substr(card_number, 1, 6) AS card_bin,
        right(card_number, 4) AS card_last4 FROM raw_cards""",
    "schema_evolution": f"""WITH {RAW} SELECT id, amount, CASE WHEN seq > 0 AND event_date >= DATE '2024-01-16'
        THEN {DEVICE} END AS device_type FROM raw""",
    "rescued_data": f"""WITH {RAW} SELECT id, amount, CASE WHEN event_date >= DATE '2024-01-16'
        THEN {DEVICE} END AS rescued_device_type FROM raw""",
    "drift_ignore": f"WITH {RAW} SELECT id, amount, true AS nothing_rescued FROM raw",
    "drift_fail": f"WITH {RAW} SELECT id, amount, true AS stopped FROM raw WHERE seq > 0",
    "lineage": f"""WITH {RAW} SELECT CAST(delivery_date AS VARCHAR) AS delivery_date, count(*) AS n_rows,
        count(*) AS n_timed FROM raw GROUP BY 1""",
    "full_refresh": f"""WITH {RAW} SELECT id, amount, g AS generation FROM raw, (SELECT unnest([1, 2]) AS g)""",
    "csv_text_scan": f"""WITH {CLIENTS} SELECT id, '$' || CAST((n % 1000) * 100 AS VARCHAR) AS yearly_income,
        CAST(20 + n % 50 AS VARCHAR) || '.25' AS latitude, CAST(num_credit_cards AS VARCHAR) AS num_credit_cards FROM raw_clients""",
    "csv_line_breaks": f"""WITH {CLIENTS} SELECT id, address || CASE WHEN n % 3 = 0
        THEN chr(10) || '2nd floor, "left"' || chr(10) || id ELSE '' END AS address,
        CAST(num_credit_cards AS VARCHAR) AS num_credit_cards, true AS nothing_rescued FROM raw_clients""",
    "csv_inferred_scan": f"""WITH {CLIENTS} SELECT n AS id, latitude, CAST(num_credit_cards AS BIGINT) AS num_credit_cards FROM raw_clients""",
    "csv_plain_scan": f"""WITH {CLIENTS} SELECT id, CAST(20 + n % 50 AS VARCHAR) || '.25' AS latitude,
        CAST(credit_score AS VARCHAR) AS credit_score FROM raw_clients""",
    "json_folder_scan": f"WITH {RAW} SELECT event_id, seq, id, amount, delivery_date AS date_partition FROM raw",
    "sorted_by_count": f"""WITH {RAW}, c AS (SELECT use_chip, count(*) AS n_rows FROM raw GROUP BY use_chip)
        SELECT use_chip, n_rows, row_number() OVER (ORDER BY n_rows DESC, use_chip NULLS FIRST) AS place FROM c""",
    "sorted_by_key": """SELECT CAST(c_custkey AS VARCHAR) AS id, row_number() OVER (ORDER BY c_custkey) AS place FROM customer""",
    "silver_transactions": f"WITH {TYPED} SELECT id, event_ts, amount, card_id, use_chip, merchant_zip FROM current_tx",
    "silver_quarantine": f"""WITH {TYPED} SELECT id, amount, event_ts, card_id, use_chip, reason
        FROM judged WHERE reason IS NOT NULL""",
    "silver_requeue": f"""WITH {TYPED} SELECT id, amount, card_id, NULL AS reason FROM current_tx
        UNION ALL SELECT id, amount, card_id, reason FROM judged WHERE reason IS NOT NULL""",
    "silver_quality_metrics": f"""WITH {TYPED}, runs AS (
          SELECT *, CASE WHEN seq = 0 THEN 'run-1' ELSE 'run-2' END AS run_id FROM tx_rules),
        lines AS ({_rules("runs", TX_RULES, "run_id")})
        SELECT run_id, 'transactions' AS table_name, rule, passed, failed,
          round(100.0 * CAST(failed AS DOUBLE) / nullif(passed + failed, 0), 4) AS pct_failed FROM lines""",
    "silver_cards": f"""WITH {CARDS} SELECT * EXCLUDE (n) REPLACE (CAST(12400 AS DECIMAL(12,2)) AS credit_limit)
        FROM typed_cards""",
    "silver_clients": f"""WITH {CLIENTS} SELECT id, yearly_income, total_debt, DATE '2017-01-01' AS valid_from_date,
          yearly_income = 64200 AS is_current, yearly_income = 64200 AS is_open FROM raw_clients
        UNION ALL SELECT id, 64200, total_debt, DATE '2017-01-03', true, true FROM raw_clients
          WHERE yearly_income <> 64200""",
    "silver_labels": f"WITH {LABELS} SELECT * FROM lab",
    "dim_cards": f"WITH {CARDS} SELECT * EXCLUDE (n) FROM typed_cards",
    "dim_clients": f"WITH {CLIENT_VERSIONS} SELECT * FROM client_versions",
    "fact_client_version": f"""WITH {TYPED}, {CLIENT_VERSIONS} SELECT t.id, t.event_ts, t.client_id, t.amount,
        v.yearly_income, v.valid_from FROM current_tx t LEFT JOIN client_versions v ON t.client_id = v.id
          AND v.valid_from <= t.event_ts AND (v.valid_to IS NULL OR t.event_ts < v.valid_to)""",
}
