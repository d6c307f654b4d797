"""Slowly-changing (Type 2) history for reconciled transactions.

A load is bounded by its feed: :func:`classify_feed` left-joins the incoming
rows to the *current* versions, of which a filter of the feed's ids lets pass
little more than the ids that match, so what is shuffled grows with the feed and
not with the table. The merge as one expression (:func:`scd2_merge`), which has
to give back every row anyway, is one full-outer join of the incoming rows with
the current versions on ``transaction_id``. Each joined row is classified once and emits
its output versions through ``explode`` of a small array: NEW -> [open],
CHANGED -> [close, open], UNCHANGED / ABSENT -> [keep]. Historical versions
are not touched and are unioned back without a shuffle. This replaces a
left join + inner join + anti join + four-way union with a single exchange of
each side.

Ids absent from the incoming feed stay current (no delete detection). Only
the tracked fields decide whether a row changed; other fields of an
unchanged id are not refreshed.
"""

from __future__ import annotations

from datetime import datetime
from typing import Dict, Optional, Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, StringType, StructField, StructType, TimestampNTZType

from ledgerwise import constants as C
from ledgerwise.functions import any_differs, ts_literal
from ledgerwise.operators import id_filter
from ledgerwise.operators.latest import keep_latest

# Change classes of the merge.
CHANGE_NEW = "NEW"
CHANGE_CHANGED = "CHANGED"
CHANGE_UNCHANGED = "UNCHANGED"
CHANGE_ABSENT = "ABSENT"

INCOMING_COLUMNS = ["transaction_id", "account_id", "amount", "currency", "transaction_date", "status", "recon_status"]

CURATED_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType()),
        StructField("account_id", StringType()),
        StructField("amount", DoubleType()),
        StructField("currency", StringType()),
        StructField("transaction_date", DateType()),
        StructField("status", StringType()),
        StructField("recon_status", StringType()),
        StructField("effective_start_date", TimestampNTZType()),
        StructField("effective_end_date", TimestampNTZType()),
        StructField("is_current", BooleanType()),
    ]
)

RunTs = Union[str, datetime]


def open_versions(incoming: DataFrame, run_ts: RunTs, open_end: str = C.SCD2_OPEN_END) -> DataFrame:
    """Incoming rows as new current versions starting at ``run_ts``."""
    return incoming.select(
        *INCOMING_COLUMNS,
        ts_literal(run_ts).alias("effective_start_date"),
        ts_literal(open_end).alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )


def scd2_initial(
    incoming: DataFrame, run_ts: RunTs, open_end: str = C.SCD2_OPEN_END, incoming_unique: bool = False
) -> DataFrame:
    """First load: every incoming row is open."""
    return open_versions(incoming if incoming_unique else one_per_id(incoming), run_ts, open_end)


def one_per_id(incoming: DataFrame) -> DataFrame:
    """Incoming rows reduced to one per id: the latest ``updated_at`` where
    that column is there, then the greatest of all columns. Rows with a NULL
    id name no transaction and are left out."""
    order = [c for c in ("updated_at",) if c in incoming.columns]
    return keep_latest(incoming, "transaction_id", order).winners.select(*INCOMING_COLUMNS)


def classify(
    existing: DataFrame,
    incoming: DataFrame,
    tracked: Sequence[str] = C.SCD2_TRACKED_FIELDS,
    incoming_unique: bool = False,
) -> DataFrame:
    """Full-outer join of incoming rows and current versions.

    Columns: ``change``, ``n_*`` (incoming, NULL when absent) and ``c_*``
    (current version, NULL when new). Presence is told by a marker on each
    side, so a stored version with a NULL id is ABSENT like any other unmatched
    one. ``incoming_unique`` says that ``incoming`` holds one row per id, as
    reconciled output does; otherwise it is reduced by :func:`one_per_id`.
    """
    rows = incoming.select(*INCOMING_COLUMNS) if incoming_unique else one_per_id(incoming)
    return _classified(rows, existing.filter(F.col("is_current")), "full_outer", tracked)


def _classified(rows: DataFrame, current: DataFrame, how: str, tracked: Sequence[str]) -> DataFrame:
    n = rows.select(*[F.col(c).alias(f"n_{c}") for c in INCOMING_COLUMNS], F.lit(True).alias("_in_feed"))
    cur = current.select(*[F.col(c).alias(f"c_{c}") for c in C.CURATED_COLUMNS], F.lit(True).alias("_stored"))
    j = n.join(cur, F.col("n_transaction_id") == F.col("c_transaction_id"), how)
    change = (
        F.when(F.col("_stored").isNull(), F.lit(CHANGE_NEW))
        .when(F.col("_in_feed").isNull(), F.lit(CHANGE_ABSENT))
        .when(any_differs([(f"n_{c}", f"c_{c}") for c in tracked]), F.lit(CHANGE_CHANGED))
        .otherwise(F.lit(CHANGE_UNCHANGED))
    )
    return j.withColumn("change", change).drop("_in_feed", "_stored")


def classify_feed(
    existing: DataFrame, incoming: DataFrame, feed_rows: int, tracked: Sequence[str] = C.SCD2_TRACKED_FIELDS
) -> DataFrame:
    """The incoming rows of :func:`classify`, without the ABSENT versions.

    ``incoming`` holds one row per id and is a stored frame of ``feed_rows`` rows
    (it is read twice: its ids make the filter). Before the current versions
    are shuffled, those whose id cannot be in the feed are dropped in their
    scan's stage. The number of ABSENT versions is :func:`absent_count`."""
    bits = id_filter.filter_bits(feed_rows)
    ids = id_filter.id_filter(incoming, "transaction_id", bits)
    current = id_filter.maybe_in(existing.filter(F.col("is_current")), "transaction_id", ids, bits)
    return _classified(incoming.select(*INCOMING_COLUMNS), current, "left", tracked)


def absent_count(existing: DataFrame, counts: Dict[str, int]) -> int:
    """Current versions less those that the feed met: one scan of one column."""
    met = counts["closed"] + counts["unchanged"]
    return existing.filter(F.col("is_current")).count() - met


def _version(prefix: str, start: Column, end: Column, current: Column) -> Column:
    return F.struct(
        *[F.col(f"{prefix}{c}").alias(c) for c in INCOMING_COLUMNS],
        start.alias("effective_start_date"),
        end.alias("effective_end_date"),
        current.alias("is_current"),
    )


def versions_of(classified: DataFrame, run_ts: RunTs, open_end: str = C.SCD2_OPEN_END) -> DataFrame:
    """The versions each classified row emits, curated columns only."""
    run = ts_literal(run_ts)
    change = F.col("change")
    keep = _version("c_", F.col("c_effective_start_date"), F.col("c_effective_end_date"), F.col("c_is_current"))
    close = _version("c_", F.col("c_effective_start_date"), run, F.lit(False))
    opened = _version("n_", run, ts_literal(open_end), F.lit(True))
    versions = (
        F.when(change == CHANGE_NEW, F.array(opened))
        .when(change == CHANGE_CHANGED, F.array(close, opened))
        .otherwise(F.array(keep))
    )
    return classified.select(F.explode(versions).alias("v")).select("v.*").select(*C.CURATED_COLUMNS)


def merge_classified(
    existing: DataFrame, classified: DataFrame, run_ts: RunTs, open_end: str = C.SCD2_OPEN_END
) -> DataFrame:
    """Curated table after the merge: history + versions emitted per class."""
    history = existing.filter(~F.col("is_current")).select(*C.CURATED_COLUMNS)
    return history.unionByName(versions_of(classified, run_ts, open_end))


def class_counts():
    """Aggregates over a classification of incoming rows."""
    ch = F.col("change")
    return [
        F.count_if(ch.isin(CHANGE_NEW, CHANGE_CHANGED)).alias("inserted"),
        F.count_if(ch == CHANGE_CHANGED).alias("closed"),
        F.count_if(ch == CHANGE_UNCHANGED).alias("unchanged"),
        F.count_if(ch == CHANGE_NEW).alias("new_ids"),
    ]


def incoming_counts():
    """Aggregates over incoming rows: how many, on how many dates (about), and
    per recon status."""
    return [
        F.count(F.lit(1)).alias("incoming"),
        F.approx_count_distinct("transaction_date").alias("dates"),
        *[F.count_if(F.col("recon_status") == F.lit(s)).alias(s) for s in C.RECON_STATUSES],
    ]


def scd2_merge(
    existing: Optional[DataFrame],
    incoming: DataFrame,
    run_ts: RunTs,
    tracked: Sequence[str] = C.SCD2_TRACKED_FIELDS,
    open_end: str = C.SCD2_OPEN_END,
    incoming_unique: bool = False,
) -> DataFrame:
    """New curated table. ``existing`` None means first load. ``incoming_unique``
    as in :func:`classify`."""
    if existing is None:
        return scd2_initial(incoming, run_ts, open_end, incoming_unique)
    return merge_classified(existing, classify(existing, incoming, tracked, incoming_unique), run_ts, open_end)


def scd2_counts(classified: DataFrame) -> DataFrame:
    """One row: inserted, closed, unchanged, new_ids, absent (BIGINT).

    A global aggregate: each task pre-aggregates, one tiny final merge.
    """
    return classified.agg(*class_counts(), F.count_if(F.col("change") == CHANGE_ABSENT).alias("absent"))


def incoming_of(classified: DataFrame, *changes: str) -> DataFrame:
    """Incoming rows of the given change classes (e.g. CHANGED, NEW)."""
    return classified.filter(F.col("change").isin(*changes)).select(
        *[F.col(f"n_{c}").alias(c) for c in INCOMING_COLUMNS]
    )


def current_of(classified: DataFrame, *changes: str) -> DataFrame:
    """Current versions of the given change classes, unmodified."""
    return classified.filter(F.col("change").isin(*changes)).select(
        *[F.col(f"c_{c}").alias(c) for c in C.CURATED_COLUMNS]
    )


def ids_to_close(classified: DataFrame) -> DataFrame:
    """Distinct ids whose current version is closed by this run."""
    return classified.filter(F.col("change") == CHANGE_CHANGED).select(
        F.col("c_transaction_id").alias("transaction_id")
    )


def closed_versions(classified: DataFrame, run_ts: RunTs) -> DataFrame:
    """The closed form of every changed id's current version."""
    run = ts_literal(run_ts)
    return classified.filter(F.col("change") == CHANGE_CHANGED).select(
        *[F.col(f"c_{c}").alias(c) for c in INCOMING_COLUMNS],
        F.col("c_effective_start_date").alias("effective_start_date"),
        run.alias("effective_end_date"),
        F.lit(False).alias("is_current"),
    )


def opened_versions(classified: DataFrame, run_ts: RunTs, open_end: str = C.SCD2_OPEN_END) -> DataFrame:
    """New current versions: changed ids plus new ids."""
    return open_versions(incoming_of(classified, CHANGE_CHANGED, CHANGE_NEW), run_ts, open_end)


def kept_current(classified: DataFrame) -> DataFrame:
    """Current versions that stay as they are (unchanged or absent ids)."""
    return current_of(classified, CHANGE_UNCHANGED, CHANGE_ABSENT)


def affected_dates(changes: DataFrame) -> DataFrame:
    """Business dates (``transaction_date``, distinct) whose partition changes:
    the old date of every CHANGED id, the new date of every CHANGED and NEW one."""
    dates = F.when(
        F.col("change") == CHANGE_CHANGED, F.array("c_transaction_date", "n_transaction_date")
    ).otherwise(F.array("n_transaction_date"))
    return changes.select(F.explode(dates).alias("transaction_date")).distinct()


def merge_affected(
    stored: DataFrame, changes: DataFrame, run_ts: RunTs, open_end: str = C.SCD2_OPEN_END
) -> DataFrame:
    """New content of the affected partitions: all their stored rows, where the
    current version of a CHANGED id is closed, plus the opened versions.
    ``changes`` holds the CHANGED and NEW rows of a classification; every
    current version that it changes lies in ``stored``."""
    closing = ids_to_close(changes).select(F.col("transaction_id").alias("_closing"))
    current = stored.filter(F.col("is_current")).join(closing, F.col("transaction_id") == F.col("_closing"), "left")
    hit = F.col("_closing").isNotNull()
    current = current.withColumn("effective_end_date", F.when(hit, ts_literal(run_ts)).otherwise(F.col("effective_end_date")))
    current = current.withColumn("is_current", ~hit)
    history = stored.filter(~F.col("is_current")).select(*C.CURATED_COLUMNS)
    return history.unionByName(current.select(*C.CURATED_COLUMNS)).unionByName(opened_versions(changes, run_ts, open_end))
