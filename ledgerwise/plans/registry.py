"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query builds a :class:`Scenario` over the whole tables and returns a lazy
DataFrame. Queries of stored tables, of the whole batch, of the routed quarantine
and of the stored feed write into the shared scratch folder first.
"""

from __future__ import annotations

from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import quarantine as Q
from ledgerwise.operators import reconcile, reports, scd2, summary
from ledgerwise.plans import oracle
from ledgerwise.plans.batch import run_batch, stage_incoming
from ledgerwise.plans.scenario import Scenario
from ledgerwise.sources import ndjson, tables

Query = Callable[[SparkSession, str], DataFrame]

TXN_FLAGGED = C.TRANSACTION_COLUMNS + ["dq_flag"]


def _q(fn: Callable[[Scenario], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Scenario(spark, sf_dir))

    run.__doc__ = fn.__doc__
    return run


def _flag_rows(s: Scenario, flag: str) -> DataFrame:
    return s.flagged.filter(F.col("dq_flag") == flag).select(*TXN_FLAGGED)


def _quarantine_view(q: DataFrame) -> DataFrame:
    """Comparable projection of quarantine rows: every payload field of DQ and
    ledger rows, the raw line for corrupt ones, and whether a source is named."""
    corrupt = F.col("dq_flag") == F.lit(C.FLAG_CORRUPT_JSON)
    fields = C.TRANSACTION_COLUMNS + [c for c in C.LEDGER_COLUMNS if c not in C.TRANSACTION_COLUMNS]
    # one parse of a payload for all its fields
    texts = F.json_tuple(F.when(~corrupt, F.col("raw_payload")), *fields).alias(*[f"_{c}" for c in fields])

    def payload(field: str):
        text = F.col(f"_{field}")
        return (text.cast("double") if field in ("amount", "ledger_amount") else text).alias(f"p_{field}")

    return q.select(*q.columns, texts).select(
        "transaction_id",
        "stage",
        "dq_flag",
        *[payload(c) for c in fields],
        F.when(corrupt, F.col("raw_payload")).alias("corrupt_payload"),
        F.col("source_file").isNotNull().alias("has_source"),
        *[c for c in ("run_scenario", "quarantined_at") if c in q.columns],
    )


def _quarantine_path(s: Scenario) -> str:
    path = tables.scratch_path(s.spark, "quarantine")
    tables.write_quarantine(s.quarantine_all, path, "initial", s.run_ts_initial)
    return path


def _curated_path(s: Scenario) -> str:
    path = tables.scratch_path(s.spark, "curated")
    tables.write_curated(s.curated_merged, path)
    return path


def _stored_curated(s: Scenario) -> DataFrame:
    return tables.read_curated(s.spark, _curated_path(s))


def _batch_curated(rewrite: str) -> Callable[[Scenario], DataFrame]:
    def run(s: Scenario) -> DataFrame:
        """The whole batch twice: the feeds and the ledger are written as NDJSON
        files, run_batch ingests them (initial, then updated run), and the
        curated table it maintains is read back."""
        spark = s.spark
        root = tables.scratch_path(spark, "batch")

        def lines(df: DataFrame) -> DataFrame:
            return df.select(F.to_json(F.struct(*df.columns)).alias("value"))

        tables.write_text_lines(lines(s.feed), f"{root}/txn_initial")
        tables.write_text_lines(lines(s.updated_feed), f"{root}/txn_updated")
        tables.write_text_lines(lines(s.ledger), f"{root}/ledger")
        curated, quarantine_path = f"{root}/curated", f"{root}/quarantine"
        for name, ts in (("initial", s.run_ts_initial), ("updated", s.run_ts_updated)):
            run_batch(spark, f"{root}/txn_{name}", f"{root}/ledger", curated, quarantine_path, ts, name, rewrite=rewrite)
        return tables.read_curated(spark, curated)

    return run


def _third_run(s: Scenario) -> DataFrame:
    """A merge onto a stored table that already has closed versions."""
    return scd2.scd2_merge(_stored_curated(s), s.third_reconciled, s.run_ts_third, incoming_unique=True)


def _feed_changes(s: Scenario) -> DataFrame:
    """The updated feed against the stored initial table, bounded by the feed."""
    stored = tables.staged(s.curated_initial, "curated-initial")
    incoming, counts = stage_incoming(s.updated_reconciled)
    classified = scd2.classify_feed(stored, incoming, counts["incoming"])
    return classified.select(
        *[F.col(f"n_{c}").alias(c) for c in scd2.INCOMING_COLUMNS],
        "change",
        F.col("c_amount").alias("stored_amount"),
        F.col("c_effective_start_date").alias("stored_start"),
    )


def _stage_counts(s: Scenario) -> DataFrame:
    return (
        summary.parsed_counts(s.event_lines_parsed, "ingest_transactions")
        .unionByName(summary.parsed_counts(s.ledger_lines_parsed, "ingest_ledger"))
        .unionByName(summary.dq_stage_counts(s.dq_counts))
    )


def _dq_flag_counts(s: Scenario) -> DataFrame:
    """Quarantined rows per flag, most frequent first, by counting."""
    rejected = s.dq_counts.filter(F.col("dq_flag") != F.lit(C.FLAG_OK))
    return rejected.orderBy(F.desc("n"), F.asc("dq_flag"))


def _distinct_values(s: Scenario) -> DataFrame:
    """The pick-lists: ids, statuses and dates of the curated table, and the
    flags of the DQ stage."""
    flags = s.dq_counts.filter(F.col("dq_flag") != F.lit(C.FLAG_OK))
    flags = flags.select(F.lit("dq_flag").alias("field"), F.col("dq_flag").alias("value"))
    return reports.distinct_values(s.curated_merged, oracle.DISTINCT_FIELDS).unionByName(flags)


_REGISTRY: Dict[str, Callable[[Scenario], DataFrame]] = {
    # strict NDJSON ingest
    "json_strict_parse": lambda s: s.event_lines_parsed.select(
        "transaction_id", "amount", F.col(C.CORRUPT_COL).isNotNull().alias("is_corrupt")
    ),
    "json_corrupt_capture": lambda s: s.event_split[1].select("raw_payload"),
    "ingest_clean": lambda s: s.event_split[0].select("transaction_id", "amount"),
    "ingest_ledger_clean": lambda s: s.ledger_lines_split[0].select(*C.LEDGER_COLUMNS),
    # data quality
    "dq_flag_rows": lambda s: s.flagged.select(*TXN_FLAGGED),
    "dq_null_id": lambda s: _flag_rows(s, C.FLAG_NULL_ID),
    "dq_negative_amount": lambda s: _flag_rows(s, C.FLAG_NEGATIVE_AMOUNT),
    "dq_invalid_date": lambda s: _flag_rows(s, C.FLAG_INVALID_DATE),
    "dedup_latest": lambda s: s.dedup.all_rows().select(*TXN_FLAGGED),
    "dq_clean": lambda s: s.clean.select(*TXN_FLAGGED),
    "dq_quarantine": lambda s: s.dq_quarantine.select(*TXN_FLAGGED),
    "dq_flag_counts": _dq_flag_counts,
    # quarantine
    "quarantine_union": lambda s: _quarantine_view(s.quarantine_all),
    "quarantine_browse": lambda s: _quarantine_view(
        Q.browse_quarantine(s.quarantine_all, oracle.QUARANTINE_BROWSE_FLAGS)
    ),
    "quarantine_roundtrip": lambda s: _quarantine_view(tables.read_quarantine(s.spark, _quarantine_path(s))),
    "quarantine_browse_stored": lambda s: _quarantine_view(
        Q.browse_stored_quarantine(s.spark, _quarantine_path(s), oracle.QUARANTINE_BROWSE_FLAGS)
    ),
    "ledger_surplus": lambda s: _quarantine_view(Q.build_quarantine(None, None, None, s.repeated_ledger_split.surplus)),
    "ledger_surplus_counts": lambda s: reconcile.surplus_counts(s.repeated_ledger),
    "stage_counts": _stage_counts,
    # reconciliation and summary
    "recon_rows": lambda s: s.reconciled,
    "recon_status_counts": lambda s: reports.status_counts(s.reconciled),
    "recon_repeated_ledger": lambda s: s.reconciled_repeated,
    "recon_breaks": lambda s: reports.recon_breaks(s.reconciled),
    "recon_breaks_chosen": lambda s: reports.recon_breaks(s.reconciled, oracle.CHOSEN_STATUSES),
    "recon_tolerance": lambda s: reconcile.reconcile(s.clean, s.ledger, oracle.AMOUNT_TOLERANCE, dedup_ledger=False),
    "recon_split": lambda s: summary.recon_split(s.reconciled),
    "run_summary": lambda s: s.summary,
    "run_headline": lambda s: summary.run_headline(s.summary),
    # SCD2
    "scd2_initial": lambda s: s.curated_initial,
    "scd2_merge": lambda s: s.curated_merged,
    "scd2_current": lambda s: s.curated_merged.filter(F.col("is_current")),
    "scd2_historical": lambda s: s.curated_merged.filter(~F.col("is_current")),
    "scd2_changed": lambda s: scd2.incoming_of(s.classified, scd2.CHANGE_CHANGED),
    "scd2_new_ids": lambda s: scd2.incoming_of(s.classified, scd2.CHANGE_NEW),
    "scd2_ids_to_close": lambda s: scd2.ids_to_close(s.classified),
    "scd2_closed": lambda s: scd2.closed_versions(s.classified, s.run_ts_updated),
    "scd2_kept_current": lambda s: scd2.kept_current(s.classified),
    "scd2_opened": lambda s: scd2.opened_versions(s.classified, s.run_ts_updated),
    "scd2_third_run": _third_run,
    "scd2_feed_changes": _feed_changes,
    "scd2_counts": lambda s: scd2.scd2_counts(s.classified),
    # reports over the merged history
    "scd2_history": lambda s: reports.scd2_history(s.curated_merged),
    "scd2_history_single": lambda s: reports.scd2_history(_stored_curated(s), oracle.HISTORY_ID),
    "scd2_version_counts": lambda s: reports.version_counts(s.curated_merged),
    "scd2_changed_fields": lambda s: reports.changed_fields(s.curated_merged),
    "curated_status_counts": lambda s: reports.status_counts(s.curated_merged),
    "curated_browse": lambda s: reports.curated_browse(
        s.curated_merged, oracle.BROWSE_DATES, oracle.BROWSE_STATUSES, current_only=True
    ),
    "curated_browse_stored": lambda s: reports.browse_stored_curated(
        s.spark, _curated_path(s), oracle.BROWSE_DATES, oracle.BROWSE_STATUSES, current_only=True
    ),
    "distinct_values": _distinct_values,
    "pick_list_dates": lambda s: reports.pick_list(s.curated_merged, "transaction_date"),
    "curated_roundtrip": _stored_curated,
    # end to end: NDJSON files -> run_batch (initial, updated) -> curated table
    "batch_curated": _batch_curated("affected"),
    "batch_curated_full": _batch_curated("full"),
}


def queries() -> Dict[str, Query]:
    return {name: _q(fn) for name, fn in _REGISTRY.items()}
