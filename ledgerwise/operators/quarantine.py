"""Bring every rejected record into one quarantine shape."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators.dq import RAW_DATE, RAW_UPDATED_AT
from ledgerwise.sources import tables


def source(df: DataFrame) -> Column:
    return F.col("source_file") if "source_file" in df.columns else F.lit(None).cast("string")


def corrupt_to_quarantine(corrupt: DataFrame, stage: str) -> DataFrame:
    """``(raw_payload, source_file)`` rows -> quarantine rows with a NULL id
    and flag CORRUPT_JSON."""
    return corrupt.select(
        F.lit(None).cast("string").alias("transaction_id"),
        F.col("raw_payload"),
        source(corrupt).alias("source_file"),
        F.lit(stage).alias("stage"),
        F.lit(C.FLAG_CORRUPT_JSON).alias("dq_flag"),
    )


def dq_payload(df: DataFrame) -> Column:
    """A transaction row as JSON, with the *original* date / timestamp text
    when it was kept."""
    date_text = F.col(RAW_DATE) if RAW_DATE in df.columns else F.col("transaction_date").cast("string")
    ts_text = F.col(RAW_UPDATED_AT) if RAW_UPDATED_AT in df.columns else F.col("updated_at").cast("string")
    return F.to_json(
        F.struct(
            "transaction_id",
            "account_id",
            "amount",
            "currency",
            date_text.alias("transaction_date"),
            "status",
            ts_text.alias("updated_at"),
        )
    )


def dq_to_quarantine(rejected: DataFrame, stage: str = C.STAGE_TRANSFORM) -> DataFrame:
    """Flagged transaction rows -> quarantine rows."""
    return rejected.select(
        "transaction_id",
        dq_payload(rejected).alias("raw_payload"),
        source(rejected).alias("source_file"),
        F.lit(stage).alias("stage"),
        "dq_flag",
    )


def ledger_payload() -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in C.LEDGER_COLUMNS]))


def ledger_to_quarantine(surplus: DataFrame) -> DataFrame:
    """Surplus ledger rows (repeated or missing id) -> quarantine rows."""
    return surplus.select(
        "transaction_id",
        ledger_payload().alias("raw_payload"),
        source(surplus).alias("source_file"),
        F.lit(C.STAGE_RECONCILE_LEDGER).alias("stage"),
        F.when(F.col("transaction_id").isNull(), F.lit(C.FLAG_NULL_ID))
        .otherwise(F.lit(C.FLAG_DUPLICATE))
        .alias("dq_flag"),
    )


def build_quarantine(
    txn_corrupt: Optional[DataFrame],
    ledger_corrupt: Optional[DataFrame],
    dq_quarantine: Optional[DataFrame],
    ledger_surplus: Optional[DataFrame] = None,
) -> DataFrame:
    """Union of all quarantine sources:
    ``transaction_id, raw_payload, source_file, stage, dq_flag``."""
    parts = []
    if txn_corrupt is not None:
        parts.append(corrupt_to_quarantine(txn_corrupt, C.STAGE_INGEST_TRANSACTIONS))
    if ledger_corrupt is not None:
        parts.append(corrupt_to_quarantine(ledger_corrupt, C.STAGE_INGEST_LEDGER))
    if dq_quarantine is not None:
        parts.append(dq_to_quarantine(dq_quarantine))
    if ledger_surplus is not None:
        parts.append(ledger_to_quarantine(ledger_surplus))
    if not parts:
        raise ValueError("build_quarantine needs at least one source")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*C.QUARANTINE_COLUMNS)


def browse_quarantine(quarantine: DataFrame, flags=None) -> DataFrame:
    """Rows of the chosen flags (all when ``flags`` is empty). On a table
    partitioned by ``dq_flag`` this prunes partitions."""
    return quarantine if not flags else quarantine.filter(F.col("dq_flag").isin(list(flags)))


def browse_stored_quarantine(spark: SparkSession, path: str, flags=None) -> DataFrame:
    """The same on the stored table: only the folders of the chosen flags are
    listed and opened."""
    return tables.read_quarantine(spark, path, flags or None)
