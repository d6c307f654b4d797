"""Independent SQL statements of every registered query, for DuckDB.

The views ``orders`` and ``events`` are the test tables. The CTEs restate the
feed rules and each operator's semantics in plain SQL (windows and joins
where the Spark side uses aggregations), so agreement is a real check.
"""

from __future__ import annotations

from ledgerwise import constants as C
from ledgerwise.sources import feeds

RUN_DATE = feeds.RUN_DATE
TS1 = feeds.RUN_TS_INITIAL
TS2 = feeds.RUN_TS_UPDATED
TS3 = feeds.RUN_TS_THIRD
OPEN_END = C.SCD2_OPEN_END

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'SETTLED' WHEN 'P' THEN 'PENDING' WHEN 'O' THEN 'FAILED' END"
_ID = "'TXN' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')"
_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_DATE_RE = r"^\d{4}-\d{2}-\d{2}$"
_TS_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"


def _flag_ctes(name: str, src: str, ledger: str = "ledger") -> str:
    """Parse + flag (``{name}_flag``), dedup (``{name}_dedup``), clean rows."""
    return f"""
{name}_parsed AS (
  SELECT transaction_id, account_id, amount, currency,
         CASE WHEN regexp_matches(transaction_date, '{_DATE_RE}')
              THEN CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) END AS transaction_date,
         status,
         CASE WHEN regexp_matches(updated_at, '{_TS_RE}')
              THEN try_strptime(updated_at, '%Y-%m-%dT%H:%M:%S') END AS updated_at,
         transaction_date AS transaction_date_raw, updated_at AS updated_at_raw
  FROM {src}
),
{name}_flag AS (
  SELECT *,
    CASE WHEN transaction_id IS NULL THEN 'NULL_ID'
         WHEN amount IS NULL OR amount <= 0 THEN 'NEGATIVE_AMOUNT'
         WHEN transaction_date IS NULL OR updated_at IS NULL OR transaction_date > DATE '{RUN_DATE}' THEN 'INVALID_DATE'
         ELSE 'OK' END AS dq_flag
  FROM {name}_parsed
),
{name}_ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY transaction_id
      ORDER BY updated_at DESC NULLS LAST, transaction_id DESC NULLS LAST, account_id DESC NULLS LAST,
               amount DESC NULLS LAST, currency DESC NULLS LAST, transaction_date DESC NULLS LAST,
               status DESC NULLS LAST, transaction_date_raw DESC NULLS LAST, updated_at_raw DESC NULLS LAST) AS rn
  FROM {name}_flag WHERE dq_flag = 'OK'
),
{name}_dedup AS (
  SELECT transaction_id, account_id, amount, currency, transaction_date, status, updated_at,
         transaction_date_raw, updated_at_raw,
         CASE WHEN rn > 1 THEN 'DUPLICATE' ELSE 'OK' END AS dq_flag
  FROM {name}_ranked
  UNION ALL
  SELECT transaction_id, account_id, amount, currency, transaction_date, status, updated_at,
         transaction_date_raw, updated_at_raw, dq_flag
  FROM {name}_flag WHERE dq_flag <> 'OK'
),
{name}_clean AS (SELECT * FROM {name}_dedup WHERE dq_flag = 'OK'),
{name}_recon AS (
  SELECT c.transaction_id, c.account_id, c.amount, c.currency, c.transaction_date, c.status, c.updated_at,
    CASE WHEN l.transaction_id IS NULL THEN 'UNRECONCILED'
         WHEN c.amount IS DISTINCT FROM l.ledger_amount THEN 'AMOUNT_MISMATCH'
         WHEN c.status IS DISTINCT FROM l.ledger_status THEN 'STATUS_MISMATCH'
         ELSE 'MATCHED' END AS recon_status
  FROM {name}_clean c LEFT JOIN {ledger} l ON c.transaction_id = l.transaction_id
)"""


_NO_PAYLOAD = ", ".join(
    f"CAST(NULL AS {'DOUBLE' if c in ('amount', 'ledger_amount') else 'VARCHAR'}) AS p_{c}"
    for c in C.TRANSACTION_COLUMNS + [c for c in C.LEDGER_COLUMNS if c not in C.TRANSACTION_COLUMNS]
)


def _cte() -> str:
    return f"""WITH
feed_k AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 40 = 3 THEN NULL ELSE {_ID} END AS transaction_id,
    'ACC' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS account_id,
    CASE WHEN o_orderkey % 41 = 5 THEN -o_totalprice
         WHEN o_orderkey % 83 = 7 THEN CAST(0.0 AS DOUBLE)
         WHEN o_orderkey % 89 = 1 THEN CAST(NULL AS DOUBLE)
         ELSE o_totalprice END AS amount,
    CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS currency,
    CASE WHEN o_orderkey % 43 = 7 THEN 'not-a-date' ELSE {_DAY} END AS transaction_date,
    {_STATUS} AS status,
    CASE WHEN o_orderkey % 97 = 2 THEN NULL
         ELSE {_DAY} || 'T' || lpad(CAST(o_orderkey % 20 AS VARCHAR), 2, '0') || ':15:00' END AS updated_at,
    {_DAY} AS day
  FROM orders
),
feed_all AS (
  SELECT k, transaction_id, account_id, amount, currency, transaction_date, status, updated_at FROM feed_k
  UNION ALL
  SELECT k, transaction_id, account_id, amount + CAST(1.5 AS DOUBLE), currency, transaction_date, status,
         CASE WHEN updated_at IS NULL THEN NULL ELSE day || 'T23:15:00' END
  FROM feed_k WHERE k % 37 = 11
),
feed AS (SELECT transaction_id, account_id, amount, currency, transaction_date, status, updated_at FROM feed_all),
upd AS (
  SELECT transaction_id, account_id,
         CASE WHEN k % 19 = 8 THEN amount + CAST(50.0 AS DOUBLE) ELSE amount END AS amount,
         currency, transaction_date,
         CASE WHEN k % 23 = 9 THEN 'REVERSED' ELSE status END AS status, updated_at
  FROM feed_all WHERE k % 29 <> 10
),
ledger AS (
  SELECT {_ID} AS transaction_id, 'Y' AS cleared_flag, {_DAY} AS cleared_date,
         CASE WHEN o_orderkey % 13 = 4 THEN o_totalprice + CAST(10.0 AS DOUBLE) ELSE o_totalprice END AS ledger_amount,
         CASE WHEN o_orderkey % 17 = 6 THEN 'REVERSED' WHEN o_orderkey % 59 = 0 THEN NULL ELSE {_STATUS} END AS ledger_status
  FROM orders WHERE o_orderkey % 11 <> 9
),
{_flag_ctes("f", "feed")},
{_flag_ctes("u", "upd")},
third AS (
  SELECT transaction_id, account_id,
         CASE WHEN k % 38 = 8 THEN amount + CAST(75.0 AS DOUBLE) WHEN k % 19 = 8 THEN amount + CAST(50.0 AS DOUBLE)
              WHEN k % 47 = 3 THEN amount + CAST(5.0 AS DOUBLE) ELSE amount END AS amount,
         currency, transaction_date, status, updated_at
  FROM feed_all WHERE k % 31 <> 4
),
{_flag_ctes("t", "third")},
ledger_k AS (
  SELECT CAST(substr(transaction_id, 4, 9) AS BIGINT) AS k, * FROM ledger
),
repeated_all AS (
  SELECT k, transaction_id, cleared_flag, cleared_date, ledger_amount, ledger_status FROM ledger_k
  UNION ALL
  SELECT k, transaction_id, cleared_flag, strftime(CAST(cleared_date AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d'),
         ledger_amount + CAST(1.0 AS DOUBLE), ledger_status
  FROM ledger_k WHERE k % 21 = 2
  UNION ALL
  SELECT k, transaction_id, cleared_flag, cleared_date, ledger_amount, ledger_status
  FROM ledger_k WHERE k % 33 = 7 AND k % 21 <> 2
),
repeated_ledger AS (
  SELECT CASE WHEN k % 45 = 11 THEN NULL ELSE transaction_id END AS transaction_id,
         cleared_flag, cleared_date, ledger_amount, ledger_status
  FROM repeated_all
),
repeated_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY cleared_date DESC NULLS LAST,
      cleared_flag DESC NULLS LAST, ledger_amount DESC NULLS LAST, ledger_status DESC NULLS LAST) AS rn
  FROM repeated_ledger
),
ledger_unique AS (SELECT * FROM repeated_ranked WHERE rn = 1 AND transaction_id IS NOT NULL),
ledger_surplus AS (
  SELECT *, CASE WHEN transaction_id IS NULL THEN 'NULL_ID' ELSE 'DUPLICATE' END AS dq_flag
  FROM repeated_ranked WHERE rn > 1 OR transaction_id IS NULL
),
r_recon AS (
  SELECT c.transaction_id, c.account_id, c.amount, c.currency, c.transaction_date, c.status, c.updated_at,
    CASE WHEN l.transaction_id IS NULL THEN 'UNRECONCILED'
         WHEN c.amount IS DISTINCT FROM l.ledger_amount THEN 'AMOUNT_MISMATCH'
         WHEN c.status IS DISTINCT FROM l.ledger_status THEN 'STATUS_MISMATCH'
         ELSE 'MATCHED' END AS recon_status
  FROM f_clean c LEFT JOIN ledger_unique l ON c.transaction_id = l.transaction_id
),
ev_lines AS (
  SELECT CASE
    WHEN event_id % 50 = 7 THEN '{{"transaction_id":"E' || CAST(event_id AS VARCHAR) || '","amount":'
    WHEN event_id % 70 = 9 THEN '{{"transaction_id":"E' || CAST(event_id AS VARCHAR) || '","amount":"N/A"}}'
    ELSE '{{"transaction_id":"E' || CAST(event_id AS VARCHAR) || '","amount":'
         || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '}}' END AS line
  FROM events
),
ev_parsed AS (
  SELECT line,
    coalesce(CASE WHEN json_valid(line) THEN json_type(line, '$.amount') IN ('BIGINT', 'UBIGINT', 'DOUBLE') END,
             false) AS ok,
    CASE WHEN json_valid(line) THEN line ->> '$.transaction_id' END AS transaction_id
  FROM ev_lines
),
ev AS (
  SELECT CASE WHEN json_valid(line) THEN transaction_id END AS transaction_id,
         CASE WHEN ok THEN CAST(line ->> '$.amount' AS DOUBLE) END AS amount,
         NOT ok AS is_corrupt, line
  FROM ev_parsed
),
ledger_lines AS (
  SELECT CASE WHEN o_orderkey % 53 = 5 THEN '{{{{' ELSE '{{' END
      || '"transaction_id":"' || {_ID} || '","cleared_flag":"Y","cleared_date":"' || {_DAY}
      || '","ledger_amount":' || CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR)
      || ',"ledger_status":'
      || coalesce('"' || (CASE WHEN o_orderkey % 17 = 6 THEN 'REVERSED' WHEN o_orderkey % 59 = 0 THEN NULL
                               ELSE {_STATUS} END) || '"', 'null')
      || '}}' AS line
  FROM orders WHERE o_orderkey % 11 <> 9
),
ledger_lines_parsed AS (
  SELECT line, json_valid(line) AS ok FROM ledger_lines
),
quarantine_all AS (
  SELECT CAST(NULL AS VARCHAR) AS transaction_id, 'INGEST_TRANSACTIONS' AS stage, 'CORRUPT_JSON' AS dq_flag,
         {_NO_PAYLOAD}, line AS corrupt_payload, false AS has_source
  FROM ev WHERE is_corrupt
  UNION ALL
  SELECT CAST(NULL AS VARCHAR), 'INGEST_LEDGER', 'CORRUPT_JSON', {_NO_PAYLOAD}, line, false
  FROM ledger_lines_parsed WHERE NOT ok
  UNION ALL
  SELECT transaction_id, 'TRANSFORM', dq_flag, transaction_id, account_id, amount, currency,
         transaction_date_raw, status, updated_at_raw, NULL, NULL, NULL, NULL, NULL, false
  FROM f_dedup WHERE dq_flag <> 'OK'
  UNION ALL
  SELECT transaction_id, 'RECONCILE_LEDGER', dq_flag, transaction_id, NULL, NULL, NULL, NULL, NULL, NULL,
         cleared_flag, cleared_date, ledger_amount, ledger_status, NULL, false
  FROM ledger_surplus
),
cur1 AS (
  SELECT transaction_id, account_id, amount, currency, transaction_date, status, recon_status,
         CAST(TIMESTAMP '{TS1}' AS TIMESTAMP) AS effective_start_date,
         CAST(TIMESTAMP '{OPEN_END}' AS TIMESTAMP) AS effective_end_date, true AS is_current
  FROM f_recon
),
cls AS (
  SELECT n.transaction_id AS n_transaction_id, n.account_id AS n_account_id, n.amount AS n_amount,
         n.currency AS n_currency, n.transaction_date AS n_transaction_date, n.status AS n_status,
         n.recon_status AS n_recon_status,
         c.transaction_id AS c_transaction_id, c.account_id AS c_account_id, c.amount AS c_amount,
         c.currency AS c_currency, c.transaction_date AS c_transaction_date, c.status AS c_status,
         c.recon_status AS c_recon_status, c.effective_start_date AS c_start, c.effective_end_date AS c_end,
         c.is_current AS c_is_current,
         CASE WHEN c.transaction_id IS NULL THEN 'NEW'
              WHEN n.transaction_id IS NULL THEN 'ABSENT'
              WHEN n.amount IS DISTINCT FROM c.amount OR n.status IS DISTINCT FROM c.status
                   OR n.recon_status IS DISTINCT FROM c.recon_status THEN 'CHANGED'
              ELSE 'UNCHANGED' END AS change
  FROM u_recon n FULL OUTER JOIN (SELECT * FROM cur1 WHERE is_current) c ON n.transaction_id = c.transaction_id
),
kept AS (
  SELECT c_transaction_id AS transaction_id, c_account_id AS account_id, c_amount AS amount,
         c_currency AS currency, c_transaction_date AS transaction_date, c_status AS status,
         c_recon_status AS recon_status, c_start AS effective_start_date, c_end AS effective_end_date,
         c_is_current AS is_current
  FROM cls WHERE change IN ('UNCHANGED', 'ABSENT')
),
closed AS (
  SELECT c_transaction_id AS transaction_id, c_account_id AS account_id, c_amount AS amount,
         c_currency AS currency, c_transaction_date AS transaction_date, c_status AS status,
         c_recon_status AS recon_status, c_start AS effective_start_date,
         CAST(TIMESTAMP '{TS2}' AS TIMESTAMP) AS effective_end_date, false AS is_current
  FROM cls WHERE change = 'CHANGED'
),
opened AS (
  SELECT n_transaction_id AS transaction_id, n_account_id AS account_id, n_amount AS amount,
         n_currency AS currency, n_transaction_date AS transaction_date, n_status AS status,
         n_recon_status AS recon_status, CAST(TIMESTAMP '{TS2}' AS TIMESTAMP) AS effective_start_date,
         CAST(TIMESTAMP '{OPEN_END}' AS TIMESTAMP) AS effective_end_date, true AS is_current
  FROM cls WHERE change IN ('CHANGED', 'NEW')
),
merged AS (
  SELECT * FROM cur1 WHERE NOT is_current
  UNION ALL SELECT * FROM kept
  UNION ALL SELECT * FROM closed
  UNION ALL SELECT * FROM opened
),
current2 AS (SELECT * FROM merged WHERE is_current),
third_changed AS (
  SELECT n.* FROM t_recon n JOIN current2 c USING (transaction_id)
  WHERE n.amount IS DISTINCT FROM c.amount OR n.status IS DISTINCT FROM c.status
     OR n.recon_status IS DISTINCT FROM c.recon_status
),
third_new AS (SELECT * FROM t_recon WHERE transaction_id NOT IN (SELECT transaction_id FROM current2)),
merged3 AS (
  SELECT * FROM merged WHERE NOT is_current
  UNION ALL
  SELECT * REPLACE (
      CASE WHEN transaction_id IN (SELECT transaction_id FROM third_changed)
           THEN CAST(TIMESTAMP '{TS3}' AS TIMESTAMP) ELSE effective_end_date END AS effective_end_date,
      transaction_id NOT IN (SELECT transaction_id FROM third_changed) AS is_current)
  FROM current2
  UNION ALL
  SELECT transaction_id, account_id, amount, currency, transaction_date, status, recon_status,
         CAST(TIMESTAMP '{TS3}' AS TIMESTAMP), CAST(TIMESTAMP '{OPEN_END}' AS TIMESTAMP), true
  FROM (SELECT * FROM third_changed UNION ALL SELECT * FROM third_new)
)
"""


TXN = "transaction_id, account_id, amount, currency, transaction_date, status, updated_at"
CUR = ", ".join(C.CURATED_COLUMNS)
INC = "transaction_id, account_id, amount, currency, transaction_date, status, recon_status"

# Parameters of the browsing queries (shared with the Spark side).
BROWSE_DATES = [f"{y}-{m:02d}-01" for y in range(1995, 2002) for m in range(1, 13)]
BROWSE_STATUSES = [C.RECON_AMOUNT_MISMATCH, C.RECON_STATUS_MISMATCH, C.RECON_UNRECONCILED]
QUARANTINE_BROWSE_FLAGS = [C.FLAG_INVALID_DATE, C.FLAG_DUPLICATE, C.FLAG_CORRUPT_JSON]
DISTINCT_FIELDS = ["transaction_id", "recon_status", "transaction_date"]
CHOSEN_STATUSES = [C.RECON_UNRECONCILED, C.RECON_STATUS_MISMATCH]
HISTORY_ID = "TXN000000008"
AMOUNT_TOLERANCE = 5.0


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _summary_sql() -> str:
    recon_rows = " UNION ALL ".join(
        f"SELECT 'recon_status' AS section, '{s}' AS metric, count_if(recon_status = '{s}') AS value FROM f_recon"
        for s in C.RECON_STATUSES
    )
    flag_rows = " UNION ALL ".join(
        f"SELECT 'quarantined_by_flag', '{f}', count_if(dq_flag = '{f}') FROM run_quarantine" for f in C.QUARANTINE_FLAGS
    )
    stage_rows = " UNION ALL ".join(
        f"SELECT 'quarantined_by_stage', '{st}', count_if(stage = '{st}') FROM run_quarantine"
        for st in ("INGEST_TRANSACTIONS", "INGEST_LEDGER", "TRANSFORM", "RECONCILE_LEDGER")
    )
    return f"""
SELECT section, metric, CAST(value AS BIGINT) AS value FROM (
  WITH run_quarantine AS (SELECT * FROM quarantine_all WHERE stage <> 'RECONCILE_LEDGER')
  SELECT 'totals' AS section, 'ingested_total' AS metric,
         (SELECT count(*) FROM feed) + (SELECT count(*) FROM ev WHERE is_corrupt) AS value
  UNION ALL SELECT 'totals', 'dq_passed', count(*) FROM f_recon
  UNION ALL SELECT 'totals', 'quarantined_total', count(*) FROM run_quarantine
  UNION ALL {flag_rows}
  UNION ALL {stage_rows}
  UNION ALL {recon_rows}
  UNION ALL SELECT 'reconciliation', 'reconciled_total', count_if(recon_status <> 'UNRECONCILED') FROM f_recon
  UNION ALL SELECT 'reconciliation', 'unreconciled_total', count_if(recon_status = 'UNRECONCILED') FROM f_recon
)"""


def _bodies() -> dict:
    changed_cols = ", ".join(
        f"CASE WHEN count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 1 THEN '{c}' END"
        for c in C.SCD2_TRACKED_FIELDS
    )
    distinct_union = " UNION ".join(
        f"SELECT '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM merged WHERE {c} IS NOT NULL"
        for c in DISTINCT_FIELDS
    )
    return {
        # --- strict NDJSON ingest
        "json_strict_parse": "SELECT transaction_id, amount, is_corrupt FROM ev",
        "json_corrupt_capture": "SELECT line AS raw_payload FROM ev WHERE is_corrupt",
        "ingest_clean": "SELECT transaction_id, amount FROM ev WHERE NOT is_corrupt",
        "ingest_ledger_clean": """
            SELECT line ->> '$.transaction_id' AS transaction_id, line ->> '$.cleared_flag' AS cleared_flag,
                   line ->> '$.cleared_date' AS cleared_date,
                   CAST(line ->> '$.ledger_amount' AS DOUBLE) AS ledger_amount,
                   line ->> '$.ledger_status' AS ledger_status
            FROM ledger_lines_parsed WHERE ok""",
        # --- data quality
        "dq_flag_rows": f"SELECT {TXN}, dq_flag FROM f_flag",
        "dq_null_id": f"SELECT {TXN}, dq_flag FROM f_flag WHERE dq_flag = 'NULL_ID'",
        "dq_negative_amount": f"SELECT {TXN}, dq_flag FROM f_flag WHERE dq_flag = 'NEGATIVE_AMOUNT'",
        "dq_invalid_date": f"SELECT {TXN}, dq_flag FROM f_flag WHERE dq_flag = 'INVALID_DATE'",
        "dedup_latest": f"SELECT {TXN}, dq_flag FROM f_dedup",
        "dq_clean": f"SELECT {TXN}, dq_flag FROM f_clean",
        "dq_quarantine": f"SELECT {TXN}, dq_flag FROM f_dedup WHERE dq_flag <> 'OK'",
        "dq_flag_counts": "SELECT dq_flag, count(*) AS n FROM f_dedup WHERE dq_flag <> 'OK' GROUP BY dq_flag",
        # --- quarantine
        "quarantine_union": "SELECT * FROM quarantine_all",
        "quarantine_browse": f"SELECT * FROM quarantine_all WHERE dq_flag IN ({_in(QUARANTINE_BROWSE_FLAGS)})",
        "quarantine_roundtrip": f"""
            SELECT *, 'initial' AS run_scenario, CAST(TIMESTAMP '{TS1}' AS TIMESTAMP) AS quarantined_at
            FROM quarantine_all""",
        "quarantine_browse_stored": f"""
            SELECT *, 'initial' AS run_scenario, CAST(TIMESTAMP '{TS1}' AS TIMESTAMP) AS quarantined_at
            FROM quarantine_all WHERE dq_flag IN ({_in(QUARANTINE_BROWSE_FLAGS)})""",
        "ledger_surplus": "SELECT * FROM quarantine_all WHERE stage = 'RECONCILE_LEDGER'",
        "ledger_surplus_counts": "SELECT dq_flag, count(*) AS n FROM ledger_surplus GROUP BY dq_flag",
        "stage_counts": """
            SELECT stage, metric, CAST(value AS BIGINT) AS value FROM (
              SELECT 'ingest_transactions' AS stage, 'clean' AS metric, count_if(NOT is_corrupt) AS value FROM ev
              UNION ALL SELECT 'ingest_transactions', 'corrupt', count_if(is_corrupt) FROM ev
              UNION ALL SELECT 'ingest_ledger', 'clean', count_if(ok) FROM ledger_lines_parsed
              UNION ALL SELECT 'ingest_ledger', 'corrupt', count_if(NOT ok) FROM ledger_lines_parsed
              UNION ALL SELECT 'dq', 'passed', count(*) FROM f_clean
              UNION ALL SELECT 'dq', 'quarantined', count(*) FROM f_dedup WHERE dq_flag <> 'OK')""",
        # --- reconciliation and summary
        "recon_rows": "SELECT * FROM f_recon",
        "recon_status_counts": "SELECT recon_status, count(*) AS n FROM f_recon GROUP BY recon_status",
        "recon_breaks": "SELECT * FROM f_recon WHERE recon_status <> 'MATCHED'",
        "recon_repeated_ledger": "SELECT * FROM r_recon",
        "recon_breaks_chosen": f"SELECT * FROM f_recon WHERE recon_status IN ({_in(CHOSEN_STATUSES)})",
        "recon_tolerance": f"""
            SELECT c.transaction_id, c.account_id, c.amount, c.currency, c.transaction_date, c.status, c.updated_at,
              CASE WHEN l.transaction_id IS NULL THEN 'UNRECONCILED'
                   WHEN (c.amount IS NULL) <> (l.ledger_amount IS NULL) OR abs(c.amount - l.ledger_amount) > {AMOUNT_TOLERANCE}
                     THEN 'AMOUNT_MISMATCH'
                   WHEN c.status IS DISTINCT FROM l.ledger_status THEN 'STATUS_MISMATCH'
                   ELSE 'MATCHED' END AS recon_status
            FROM f_clean c LEFT JOIN ledger l ON c.transaction_id = l.transaction_id""",
        "recon_split": """
            SELECT count_if(recon_status <> 'UNRECONCILED') AS reconciled,
                   count_if(recon_status = 'UNRECONCILED') AS unreconciled FROM f_recon""",
        "run_summary": _summary_sql(),
        "run_headline": f"""
            SELECT max(CASE WHEN metric = 'ingested_total' THEN value END) AS ingested,
                   max(CASE WHEN metric = 'dq_passed' THEN value END) AS passed,
                   max(CASE WHEN metric = 'quarantined_total' THEN value END) AS quarantined,
                   max(CASE WHEN metric = 'reconciled_total' THEN value END) AS reconciled,
                   max(CASE WHEN metric = 'unreconciled_total' THEN value END) AS unreconciled
            FROM ({_summary_sql()})""",
        # --- SCD2
        "scd2_initial": f"SELECT {CUR} FROM cur1",
        "scd2_merge": f"SELECT {CUR} FROM merged",
        "scd2_current": f"SELECT {CUR} FROM merged WHERE is_current",
        "scd2_historical": f"SELECT {CUR} FROM merged WHERE NOT is_current",
        "scd2_changed": f"""
            SELECT {", ".join(f"n_{c} AS {c}" for c in INC.split(", "))} FROM cls WHERE change = 'CHANGED'""",
        "scd2_new_ids": f"""
            SELECT {", ".join(f"n_{c} AS {c}" for c in INC.split(", "))} FROM cls WHERE change = 'NEW'""",
        "scd2_ids_to_close": "SELECT c_transaction_id AS transaction_id FROM cls WHERE change = 'CHANGED'",
        "scd2_closed": f"SELECT {CUR} FROM closed",
        "scd2_kept_current": f"SELECT {CUR} FROM kept",
        "scd2_opened": f"SELECT {CUR} FROM opened",
        "scd2_third_run": f"SELECT {CUR} FROM merged3",
        "scd2_counts": """
            SELECT count_if(change IN ('NEW', 'CHANGED')) AS inserted, count_if(change = 'CHANGED') AS closed,
                   count_if(change = 'UNCHANGED') AS unchanged, count_if(change = 'NEW') AS new_ids,
                   count_if(change = 'ABSENT') AS absent
            FROM cls""",
        "scd2_feed_changes": f"""
            SELECT {", ".join(f"n_{c} AS {c}" for c in INC.split(", "))}, change, c_amount AS stored_amount,
                   c_start AS stored_start
            FROM cls WHERE change <> 'ABSENT'""",
        # --- reports over the merged history
        "scd2_history": """
            SELECT transaction_id,
                   CAST(row_number() OVER (PARTITION BY transaction_id
                        ORDER BY effective_start_date, effective_end_date) AS INTEGER) AS version,
                   effective_start_date, effective_end_date, is_current, amount, status, recon_status
            FROM merged""",
        "scd2_history_single": f"""
            SELECT transaction_id,
                   CAST(row_number() OVER (ORDER BY effective_start_date, effective_end_date) AS INTEGER) AS version,
                   effective_start_date, effective_end_date, is_current, amount, status, recon_status
            FROM merged WHERE transaction_id = '{HISTORY_ID}'""",
        "scd2_version_counts": "SELECT transaction_id, count(*) AS versions FROM merged GROUP BY transaction_id",
        "scd2_changed_fields": f"""
            SELECT transaction_id, count(*) AS versions, concat_ws(',', {changed_cols}) AS changed_fields
            FROM merged GROUP BY transaction_id HAVING count(*) > 1""",
        "curated_status_counts": "SELECT recon_status, count(*) AS n FROM merged GROUP BY recon_status",
        "curated_browse": f"""
            SELECT {CUR} FROM merged
            WHERE transaction_date IN ({", ".join(f"DATE '{d}'" for d in BROWSE_DATES)})
              AND recon_status IN ({_in(BROWSE_STATUSES)}) AND is_current""",
        "curated_browse_stored": f"""
            SELECT {CUR} FROM merged
            WHERE transaction_date IN ({", ".join(f"DATE '{d}'" for d in BROWSE_DATES)})
              AND recon_status IN ({_in(BROWSE_STATUSES)}) AND is_current""",
        "distinct_values": f"""
            {distinct_union}
            UNION SELECT 'dq_flag', dq_flag FROM f_dedup WHERE dq_flag <> 'OK'""",
        "pick_list_dates": "SELECT DISTINCT transaction_date AS value FROM merged WHERE transaction_date IS NOT NULL",
        "curated_roundtrip": f"SELECT {CUR} FROM merged",
        "batch_curated": f"SELECT {CUR} FROM merged",
        "batch_curated_full": f"SELECT {CUR} FROM merged",
    }


def oracle_sql() -> dict:
    cte = _cte()
    return {name: cte + body for name, body in _bodies().items()}
