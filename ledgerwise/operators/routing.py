"""Every parsed row gets its stage and flag in one pass, and goes one of two ways.

The pass over an input evaluates parsing and rules once per row and writes the
row to the shared scratch folder: rejected rows already in quarantine shape, OK
rows with their columns. What follows reads one way only: the quarantine takes
the rejected rows as they are, dedup and reconciliation start from the OK rows.
"""

from __future__ import annotations

from datetime import date
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.functions import first_match
from ledgerwise.operators import dq, quarantine
from ledgerwise.operators.latest import LatestSplit, keep_latest
from ledgerwise.sources import tables

ROUTE, OK, REJECTED = "_route", "ok", "rejected"


class Routed:
    """``ok`` rows with their columns, ``rejected`` ones in quarantine shape."""

    def __init__(self, stored: DataFrame, columns):
        self.ok = stored.filter(F.col(ROUTE) == OK).select(*columns)
        rejected = stored.filter(F.col(ROUTE) == REJECTED)
        self.rejected = rejected.select(*[F.col(f"_q_{c}").alias(c) for c in C.QUARANTINE_COLUMNS])


def _routed(flagged: DataFrame, flag: Column, stage: Column, payload: Column, name: str) -> Routed:
    columns = [c for c in flagged.columns if c not in (C.CORRUPT_COL, "dq_flag")]
    corrupt = _corrupt(flagged)
    line = F.col(C.CORRUPT_COL) if C.CORRUPT_COL in flagged.columns else F.lit(None).cast("string")
    shape = {
        "transaction_id": F.when(~corrupt, F.col("transaction_id")),
        "raw_payload": F.when(corrupt, line).otherwise(payload),
        "source_file": quarantine.source(flagged),
        "stage": stage,
        "dq_flag": F.col("_flag"),
    }
    rejected = F.col("_flag") != C.FLAG_OK
    rows = flagged.withColumn("_flag", flag).select(
        *columns,
        *[F.when(rejected, shape[c]).alias(f"_q_{c}") for c in C.QUARANTINE_COLUMNS],
        F.when(rejected, F.lit(REJECTED)).otherwise(F.lit(OK)).alias(ROUTE),
    )
    return Routed(tables.staged(rows, name, [ROUTE]), columns)


def _corrupt(df: DataFrame) -> Column:
    return F.col(C.CORRUPT_COL).isNotNull() if C.CORRUPT_COL in df.columns else F.lit(False)


def route_transactions(parsed: DataFrame, run_date: Union[date, str]) -> Routed:
    """Transactions, parsed from lines (with the corrupt column) or not: flags
    CORRUPT_JSON, then the DQ rules, then OK. Runs one write."""
    flagged = dq.apply_dq_rules(parsed, run_date)
    corrupt = _corrupt(flagged)
    flag = F.when(corrupt, F.lit(C.FLAG_CORRUPT_JSON)).otherwise(F.col("dq_flag"))
    stage = F.when(corrupt, F.lit(C.STAGE_INGEST_TRANSACTIONS)).otherwise(F.lit(C.STAGE_TRANSFORM))
    return _routed(flagged, flag, stage, quarantine.dq_payload(flagged), "routed-transactions")


def route_ledger(parsed: DataFrame) -> Routed:
    """Ledger rows: flags CORRUPT_JSON, NULL_ID, then OK. Runs one write."""
    corrupt = _corrupt(parsed)
    flag = first_match([(corrupt, C.FLAG_CORRUPT_JSON), (F.col("transaction_id").isNull(), C.FLAG_NULL_ID)], C.FLAG_OK)
    stage = F.when(corrupt, F.lit(C.STAGE_INGEST_LEDGER)).otherwise(F.lit(C.STAGE_RECONCILE_LEDGER))
    return _routed(parsed, flag, stage, quarantine.ledger_payload(), "routed-ledger")


def latest_transactions(routed: Routed) -> LatestSplit:
    return keep_latest(routed.ok, "transaction_id", ["updated_at"], null_keys=False, stored=True)


def latest_ledger(routed: Routed) -> LatestSplit:
    return keep_latest(routed.ok, "transaction_id", ["cleared_date"], null_keys=False, stored=True)


def duplicates_to_quarantine(losers: DataFrame) -> DataFrame:
    return quarantine.dq_to_quarantine(losers.withColumn("dq_flag", F.lit(C.FLAG_DUPLICATE)))
