"""The end-to-end scenario over the test tables, as lazily built DataFrames.

``Scenario(spark, sf_dir)`` derives the transaction feed, the ledger, the
updated feed and NDJSON lines from ``orders`` / ``events`` and chains the
operators. Nothing is executed until a caller runs an action.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import dq, quarantine, reconcile, routing, scd2, summary
from ledgerwise.sources import feeds, ndjson


class Scenario:
    run_date = feeds.RUN_DATE
    run_ts_initial = feeds.RUN_TS_INITIAL
    run_ts_updated = feeds.RUN_TS_UPDATED
    run_ts_third = feeds.RUN_TS_THIRD

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    # --- inputs -----------------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        return feeds.table(self.spark, self.sf_dir, "orders")

    @cached_property
    def events(self) -> DataFrame:
        return feeds.table(self.spark, self.sf_dir, "events")

    @cached_property
    def feed(self) -> DataFrame:
        return feeds.transaction_feed(self.orders)

    @cached_property
    def updated_feed(self) -> DataFrame:
        return feeds.updated_transaction_feed(self.orders)

    @cached_property
    def ledger(self) -> DataFrame:
        return feeds.ledger_feed(self.orders)

    # --- strict NDJSON ingest ----------------------------------------------
    @cached_property
    def event_lines_parsed(self) -> DataFrame:
        lines = feeds.event_json_lines(self.events)
        return ndjson.parse_json_lines(lines, feeds.EVENT_LINE_SCHEMA)

    @cached_property
    def event_split(self):
        return ndjson.split_corrupt(self.event_lines_parsed)

    @cached_property
    def ledger_lines_parsed(self) -> DataFrame:
        return ndjson.parse_json_lines(feeds.ledger_json_lines(self.orders), C.LEDGER_SCHEMA)

    @cached_property
    def ledger_lines_split(self):
        return ndjson.split_corrupt(self.ledger_lines_parsed)

    # --- data quality -------------------------------------------------------
    @cached_property
    def flagged(self) -> DataFrame:
        return dq.apply_dq_rules(self.feed, self.run_date)

    @cached_property
    def dedup(self) -> dq.DedupResult:
        return dq.dedup_latest(self.flagged)

    @cached_property
    def clean(self) -> DataFrame:
        return self.dedup.kept

    @cached_property
    def dq_quarantine(self) -> DataFrame:
        return self.dedup.quarantine()

    @cached_property
    def updated_dedup(self) -> dq.DedupResult:
        return dq.dedup_latest(dq.apply_dq_rules(self.updated_feed, self.run_date))

    @cached_property
    def dq_counts(self) -> DataFrame:
        return dq.dq_counts(self.flagged)

    # --- reconciliation -----------------------------------------------------
    @cached_property
    def reconciled(self) -> DataFrame:
        return reconcile.reconcile(self.clean, self.ledger, dedup_ledger=False)

    @cached_property
    def updated_reconciled(self) -> DataFrame:
        return reconcile.reconcile(self.updated_dedup.kept, self.ledger, dedup_ledger=False)

    @cached_property
    def third_reconciled(self) -> DataFrame:
        third = dq.dedup_latest(dq.apply_dq_rules(feeds.third_transaction_feed(self.orders), self.run_date))
        return reconcile.reconcile(third.kept, self.ledger, dedup_ledger=False)

    @cached_property
    def repeated_ledger(self) -> DataFrame:
        return feeds.repeated_ledger_feed(self.orders)

    @cached_property
    def repeated_ledger_split(self) -> reconcile.LedgerSplit:
        return reconcile.unique_ledger(self.repeated_ledger)

    @cached_property
    def reconciled_repeated(self) -> DataFrame:
        """The clean rows against a ledger with repeated and missing ids."""
        return reconcile.reconcile(self.clean, self.repeated_ledger)

    # --- quarantine ------------------------------------------------------------
    @cached_property
    def routed_feed(self) -> routing.Routed:
        """The feed after one pass over it (staged)."""
        return routing.route_transactions(self.feed, self.run_date)

    @cached_property
    def routed_ledger(self) -> routing.Routed:
        """The repeated ledger after one pass over it (staged)."""
        return routing.route_ledger(self.repeated_ledger)

    @cached_property
    def quarantine_all(self) -> DataFrame:
        """Corrupt event lines + corrupt ledger lines + DQ rejects of the feed
        + surplus rows of the repeated ledger. Each input is scanned once; only
        the repeated ids of the routed OK rows are looked at again."""
        corrupt = quarantine.build_quarantine(self.event_split[1], self.ledger_lines_split[1], None)
        duplicates = routing.duplicates_to_quarantine(routing.latest_transactions(self.routed_feed).losers)
        surplus = quarantine.ledger_to_quarantine(routing.latest_ledger(self.routed_ledger).losers)
        parts = [self.routed_feed.rejected, duplicates, self.routed_ledger.rejected, surplus]
        return reduce(DataFrame.unionByName, parts, corrupt)

    # --- summary -----------------------------------------------------------------
    @cached_property
    def summary(self) -> DataFrame:
        """Of a run that has corrupt transaction and ledger lines."""
        return summary.run_summary(self.dq_counts, self.reconciled, self.event_lines_parsed, self.ledger_lines_parsed)

    # --- SCD2 ---------------------------------------------------------------------
    @cached_property
    def curated_initial(self) -> DataFrame:
        return scd2.scd2_initial(self.reconciled, self.run_ts_initial, incoming_unique=True)

    @cached_property
    def classified(self) -> DataFrame:
        return scd2.classify(self.curated_initial, self.updated_reconciled, incoming_unique=True)

    @cached_property
    def curated_merged(self) -> DataFrame:
        return scd2.merge_classified(self.curated_initial, self.classified, self.run_ts_updated)
