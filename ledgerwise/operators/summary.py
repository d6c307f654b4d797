"""Run summary and stage counts as small DataFrames (no driver round trips).

Every count is a conditional aggregate (``count_if``) over the full input:
tasks pre-aggregate and a single tiny final step merges, so these scale with
the data without a shuffle of rows. Long tables are built by ``unionByName``
of one-row aggregates unpivoted with ``stack``.
"""

from __future__ import annotations

from functools import reduce
from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwise import constants as C

QUARANTINE_STAGES = [
    C.STAGE_INGEST_TRANSACTIONS, C.STAGE_INGEST_LEDGER, C.STAGE_TRANSFORM, C.STAGE_RECONCILE_LEDGER,
]


def _long(one_row: DataFrame, section: str, metrics: Sequence[str]) -> DataFrame:
    """Unpivot a one-row frame of BIGINT metrics into (section, metric, value)."""
    args = ", ".join(f"'{m}', `{m}`" for m in metrics)
    return one_row.selectExpr(f"stack({len(metrics)}, {args}) AS (metric, value)").select(
        F.lit(section).alias("section"), "metric", F.col("value").cast("bigint").alias("value")
    )


def recon_split(reconciled: DataFrame) -> DataFrame:
    """One row: ``reconciled`` (matched or mismatched), ``unreconciled``."""
    unrec = F.col("recon_status") == F.lit(C.RECON_UNRECONCILED)
    return reconciled.agg(F.count_if(~unrec).alias("reconciled"), F.count_if(unrec).alias("unreconciled"))


def run_summary(
    dq_counts: DataFrame,
    reconciled: DataFrame,
    txn_parsed: Optional[DataFrame] = None,
    ledger_parsed: Optional[DataFrame] = None,
    ledger_surplus: Optional[DataFrame] = None,
) -> DataFrame:
    """Long table ``(section, metric, value)``.

    * ``totals``: ingested_total (transaction input rows, parsed or corrupt),
      dq_passed (rows reconciled), quarantined_total (all quarantine rows,
      ledger defects included);
    * ``quarantined_by_flag``: every flag of the domain, zero-filled;
    * ``quarantined_by_stage``: every stage, zero-filled;
    * ``recon_status``: every status of the domain, zero-filled;
    * ``reconciliation``: reconciled_total (matched + both mismatches) and
      unreconciled_total.

    ``dq_counts`` is :func:`ledgerwise.operators.dq.dq_counts` of the parsed
    feed; ``txn_parsed`` and ``ledger_parsed`` are parsed lines of which only
    the corrupt ones are counted; ``ledger_surplus`` has ``dq_flag, n`` counts
    of surplus ledger rows. No rejected row is built: every part is a count.
    """
    parts = [dq_counts.select(F.lit(C.STAGE_TRANSFORM).alias("stage"), "dq_flag", "n")]
    for stage, parsed in ((C.STAGE_INGEST_TRANSACTIONS, txn_parsed), (C.STAGE_INGEST_LEDGER, ledger_parsed)):
        if parsed is not None:
            corrupt = parsed.filter(F.col(C.CORRUPT_COL).isNotNull())
            parts.append(corrupt.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), F.lit(C.FLAG_CORRUPT_JSON).alias("dq_flag"), "n"))
    if ledger_surplus is not None:
        parts.append(ledger_surplus.select(F.lit(C.STAGE_RECONCILE_LEDGER).alias("stage"), "dq_flag", "n"))
    counts = reduce(DataFrame.unionByName, parts)

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))

    rejected = F.col("dq_flag") != F.lit(C.FLAG_OK)
    of_feed = F.col("stage").isin(C.STAGE_TRANSFORM, C.STAGE_INGEST_TRANSACTIONS)
    stages = {f"{s} rejected": s for s in QUARANTINE_STAGES}  # names apart from the flags'
    q = counts.agg(
        total(of_feed).alias("ingested_total"),
        total(rejected).alias("quarantined_total"),
        *[total(F.col("dq_flag") == F.lit(f)).alias(f) for f in C.QUARANTINE_FLAGS],
        *[total(rejected & (F.col("stage") == F.lit(s))).alias(name) for name, s in stages.items()],
    )
    unrec = F.col("recon_status") == F.lit(C.RECON_UNRECONCILED)
    r = reconciled.agg(
        F.count(F.lit(1)).alias("dq_passed"),
        *[F.count_if(F.col("recon_status") == F.lit(s)).alias(s) for s in C.RECON_STATUSES],
        F.count_if(~unrec).alias("reconciled_total"),
        F.count_if(unrec).alias("unreconciled_total"),
    )
    section = {"ingested_total": "totals", "dq_passed": "totals", "quarantined_total": "totals"}
    section.update({f: "quarantined_by_flag" for f in C.QUARANTINE_FLAGS})
    section.update({name: "quarantined_by_stage" for name in stages})
    section.update({s: "recon_status" for s in C.RECON_STATUSES})
    section.update({"reconciled_total": "reconciliation", "unreconciled_total": "reconciliation"})
    out = _long(q, "", ["ingested_total", "quarantined_total"] + C.QUARANTINE_FLAGS + list(stages)).unionByName(
        _long(r, "", ["dq_passed"] + C.RECON_STATUSES + ["reconciled_total", "unreconciled_total"])
    )
    label = F.lit(None).cast("string")
    for metric, sec in section.items():
        label = F.when(F.col("metric") == F.lit(metric), F.lit(sec)).otherwise(label)
    return out.select(label.alias("section"), F.regexp_replace("metric", " rejected$", "").alias("metric"), "value")


def parsed_counts(parsed: DataFrame, stage: str, corrupt_col: str = C.CORRUPT_COL) -> DataFrame:
    """``(stage, metric, value)`` rows ``clean`` / ``corrupt`` for a parsed
    NDJSON frame, from one conditional aggregate."""
    bad = F.col(corrupt_col).isNotNull()
    one = parsed.agg(F.count_if(~bad).alias("clean"), F.count_if(bad).alias("corrupt"))
    return _long(one, stage, ["clean", "corrupt"]).withColumnRenamed("section", "stage")


HEADLINE = [
    ("ingested", "ingested_total"),
    ("passed", "dq_passed"),
    ("quarantined", "quarantined_total"),
    ("reconciled", "reconciled_total"),
    ("unreconciled", "unreconciled_total"),
]


def run_headline(summary: DataFrame) -> DataFrame:
    """One row of headline metrics picked from :func:`run_summary`."""
    return summary.agg(
        *[F.max(F.when(F.col("metric") == F.lit(m), F.col("value"))).alias(name) for name, m in HEADLINE]
    )


def dq_stage_counts(dq_counts: DataFrame) -> DataFrame:
    """``(stage, metric, value)`` rows ``dq / passed`` and ``dq / quarantined``
    from :func:`ledgerwise.operators.dq.dq_counts`."""
    ok = F.col("dq_flag") == F.lit(C.FLAG_OK)
    one = dq_counts.agg(
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("passed"),
        F.coalesce(F.sum(F.when(~ok, F.col("n"))), F.lit(0)).alias("quarantined"),
    )
    return _long(one, "dq", ["passed", "quarantined"]).withColumnRenamed("section", "stage")
