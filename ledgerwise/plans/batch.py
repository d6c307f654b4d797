"""One batch run: ingest -> DQ -> reconcile -> quarantine -> SCD2 -> summary.

Every count of the run summary rides on a write as observed metrics; only the
number of ids absent from the feed takes a scan of one column. The caller owns the session.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from typing import Dict, Optional, Sequence, Tuple, Union

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import quarantine, reconcile, routing, scd2
from ledgerwise.sources import ndjson, tables


def parse_run_ts(value: Union[None, str, datetime]) -> datetime:
    """Run time as naive UTC. ``None`` means now; naive input is taken as UTC."""
    if value is None:
        return datetime.now(timezone.utc).replace(tzinfo=None)
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


@dataclass
class BatchResult:
    counts: Dict[str, int] = field(default_factory=dict)

    def summary_rows(self):
        """``(section, metric, value)`` rows in the layout of
        :func:`ledgerwise.operators.summary.run_summary`."""
        c = self.counts
        rows = [
            ("totals", "ingested_total", c["ingested_total"]),
            ("totals", "dq_passed", c["dq_passed"]),
            ("totals", "quarantined_total", c["quarantined_total"]),
        ]
        rows += [("quarantined_by_flag", f, c[f"flag_{f}"]) for f in C.QUARANTINE_FLAGS]
        rows += [("recon_status", s, c[s]) for s in C.RECON_STATUSES]
        rows += [
            ("reconciliation", "reconciled_total", c["reconciled_total"]),
            ("reconciliation", "unreconciled_total", c["unreconciled_total"]),
        ]
        return rows

    def summary(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.summary_rows(), "section string, metric string, value bigint")


def _quarantine_metrics():
    stage, flag = F.col("stage"), F.col("dq_flag")
    return [
        F.count(F.lit(1)).alias("quarantined_total"),
        *[F.count_if(flag == F.lit(f)).alias(f"flag_{f}") for f in C.QUARANTINE_FLAGS],
        *[
            F.count_if(stage == F.lit(s)).alias(f"stage_{s}")
            for s in (C.STAGE_INGEST_TRANSACTIONS, C.STAGE_INGEST_LEDGER, C.STAGE_TRANSFORM, C.STAGE_RECONCILE_LEDGER)
        ],
    ]


def run_batch(
    spark: SparkSession,
    txn_path: str,
    ledger_path: str,
    curated_path: str,
    quarantine_path: str,
    run_ts: Union[None, str, datetime] = None,
    scenario: str = "batch",
    **options,
) -> BatchResult:
    """Run one batch over NDJSON files and return its counts (see
    :func:`run_batch_lines` for the options)."""
    return run_batch_lines(
        spark,
        ndjson.read_lines(spark, txn_path),
        ndjson.read_lines(spark, ledger_path),
        curated_path,
        quarantine_path,
        run_ts,
        scenario,
        **options,
    )


def run_batch_lines(
    spark: SparkSession,
    txn_lines: DataFrame,
    ledger_lines: DataFrame,
    curated_path: str,
    quarantine_path: str,
    run_ts: Union[None, str, datetime] = None,
    scenario: str = "batch",
    run_date: Optional[Union[date, str]] = None,
    tracked: Sequence[str] = C.SCD2_TRACKED_FIELDS,
    amount_tolerance: float = 0.0,
    rewrite: str = "affected",
) -> BatchResult:
    """Run one batch over NDJSON lines (``value`` and optionally
    ``source_file`` columns) and return its counts.

    ``run_date`` (for the future-date rule) defaults to the date of ``run_ts``.
    ``rewrite`` chooses how the curated table is replaced (see
    :func:`scd2_load`).
    """
    ts = parse_run_ts(run_ts)
    run_date = run_date or ts.date()

    # One pass over each input: every row is parsed, flagged and routed once.
    txn = routing.route_transactions(ndjson.parse_json_lines(txn_lines, C.TRANSACTION_SCHEMA), run_date)
    ledger = routing.route_ledger(ndjson.parse_json_lines(ledger_lines, C.LEDGER_SCHEMA))
    latest, latest_ledger = routing.latest_transactions(txn), routing.latest_ledger(ledger)

    # One aggregate by id gives both sinks their start: the reconciled latest
    # rows for the curated table, and for the quarantine the ids that have others.
    reconciled = reconcile.reconcile(latest.counted, latest_ledger.winners, amount_tolerance, dedup_ledger=False, carry=["_rows"])
    incoming, seen = stage_incoming(reconciled, F.count_if(F.col("_rows") > 1).alias("repeated"))

    rejected = txn.rejected.unionByName(ledger.rejected)
    rejected = rejected.unionByName(quarantine.ledger_to_quarantine(latest_ledger.losers))
    if seen.pop("repeated"):
        losers = latest.losers_among(incoming.filter(F.col("_rows") > 1).select("transaction_id"))
        rejected = rejected.unionByName(routing.duplicates_to_quarantine(losers))
    qc = tables.write_quarantine(rejected, quarantine_path, scenario, ts, *_quarantine_metrics())

    cc = scd2_load(spark, incoming, ts, curated_path, tracked, rewrite, staged_counts=seen)

    counts: Dict[str, int] = {k: int(v) for k, v in {**qc, **cc}.items()}
    counts["dq_passed"] = counts["incoming"]
    counts["ingested_total"] = (
        counts[f"stage_{C.STAGE_INGEST_TRANSACTIONS}"] + counts[f"stage_{C.STAGE_TRANSFORM}"] + counts["dq_passed"]
    )
    counts["unreconciled_total"] = counts[C.RECON_UNRECONCILED]
    counts["reconciled_total"] = counts["dq_passed"] - counts["unreconciled_total"]
    return BatchResult(counts)


REWRITES = ("affected", "full")


def stage_incoming(incoming: DataFrame, *metrics) -> Tuple[DataFrame, Dict[str, int]]:
    """Incoming rows (one per id) written once to the scratch folder, and their
    counts, observed in that write's last stage."""
    seen = Observation()
    stored = tables.staged(incoming.observe(seen, *scd2.incoming_counts(), *metrics), "incoming")
    return stored, {k: int(v) for k, v in seen.get.items()}


def scd2_load(
    spark: SparkSession,
    incoming: DataFrame,
    ts: datetime,
    curated_path: str,
    tracked: Sequence[str] = C.SCD2_TRACKED_FIELDS,
    rewrite: str = "affected",
    staged_counts: Optional[Dict[str, int]] = None,
) -> Dict[str, int]:
    """Merge ``incoming`` into the curated table and return the run counts.

    The table is opened at one version, and all that is read and published
    refers to it; :class:`ledgerwise.sources.tables.ConcurrentWrite` means that
    another run came in between and nothing was changed.

    ``incoming`` is reduced to one row per id and staged, unless
    ``staged_counts`` says that it comes from :func:`stage_incoming`. The
    classification is a left join bounded by the feed
    (:func:`ledgerwise.operators.scd2.classify_feed`); its CHANGED and NEW rows are
    written to the scratch folder, with the counts observed there. The new content
    is the stored rows with the changed versions closed, plus the opened ones:

    * ``rewrite="full"``: of all partitions, as a new whole table;
    * ``rewrite="affected"``: of the partitions of the changed business dates;
      the others are neither read again nor written, and without a change
      nothing is written.

    The caller chooses, and both return the same counts. A first load is a load
    into an empty table; one onto a plain Parquet table replaces it as a whole.
    """
    if rewrite not in REWRITES:
        raise ValueError(f"rewrite is one of {REWRITES}")
    if staged_counts is None:
        incoming, staged_counts = stage_incoming(scd2.one_per_id(incoming))
    # a date's rows: about as many ids as a file of the date has
    table = tables.curated_table(spark, curated_path, staged_counts["incoming"] // max(staged_counts["dates"], 1))
    existing = table.frame()
    seen = Observation()
    classified = scd2.classify_feed(existing, incoming, staged_counts["incoming"], tracked).observe(seen, *scd2.class_counts())
    changes = tables.staged(classified.filter(F.col("change").isin(scd2.CHANGE_CHANGED, scd2.CHANGE_NEW)), "changes")
    counts = {**staged_counts, **{k: int(v) for k, v in seen.get.items()}}
    counts["absent"] = scd2.absent_count(existing, counts)
    if rewrite == "full" or not table.folders:
        table.replace(scd2.merge_affected(existing, changes, ts))
    elif counts["inserted"]:
        dates = [r[0] for r in scd2.affected_dates(changes).collect()]  # bounded by the calendar
        table.update(scd2.merge_affected(table.frame(dates), changes, ts))
    return counts


def apply_scd2(
    spark: SparkSession,
    incoming: DataFrame,
    run_ts: Union[str, datetime],
    curated_path: str,
    tracked: Sequence[str] = C.SCD2_TRACKED_FIELDS,
    rewrite: str = "affected",
) -> Dict[str, int]:
    """Merge ``incoming`` (reconciled rows) into the curated table at
    ``curated_path``; returns ``inserted, closed, unchanged, new_ids``."""
    got = scd2_load(spark, incoming, parse_run_ts(run_ts), curated_path, tracked, rewrite)
    return {k: int(got[k]) for k in ("inserted", "closed", "unchanged", "new_ids")}
