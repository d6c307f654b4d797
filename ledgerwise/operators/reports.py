"""Reporting queries over the quarantine and curated tables.

All are plain DataFrame queries, so on the partitioned tables the date and
flag filters prune partitions and the rest pushes into the Parquet scan.
"""

from __future__ import annotations

from typing import Iterable, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.sources import tables

HISTORY_COLUMNS = ["effective_start_date", "effective_end_date", "is_current", "amount", "status", "recon_status"]


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Rows per value of ``column``, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), F.asc(column))


def flag_counts(quarantine: DataFrame) -> DataFrame:
    return value_counts(quarantine, "dq_flag")


def status_counts(df: DataFrame) -> DataFrame:
    """Rows per recon status; on curated data this counts every version."""
    return value_counts(df, "recon_status")


def recon_breaks(df: DataFrame, statuses: Optional[Iterable[str]] = None) -> DataFrame:
    """Rows of the chosen statuses. Default: everything but MATCHED, or every
    row when nothing but MATCHED is present.

    The "anything but MATCHED present?" test is an uncorrelated EXISTS, which
    Spark runs as a subquery of one row: each task of its last stage stops at
    the first break it meets, and nothing is counted or written. On a frame that
    is not stored, the exchanges below are shared with the main query where
    they carry the same columns.
    """
    if statuses:
        return df.filter(F.col("recon_status").isin(list(statuses)))
    is_break = ~F.col("recon_status").eqNullSafe(F.lit(C.RECON_MATCHED))
    return df.filter(is_break | ~df.filter(is_break).exists())


def scd2_history(curated: DataFrame, transaction_id: Optional[str] = None) -> DataFrame:
    """Versions with a 1-based ``version`` number in order of their start.

    The window is keyed on the id; one id holds at most one version per run,
    so a partition of this window is bounded by the number of runs. The history
    of one id comes back in order (its filter reaches the scan); the history of
    all ids is in order inside each id, and not sorted as a whole.
    """
    df = curated if transaction_id is None else curated.filter(F.col("transaction_id") == transaction_id)
    w = Window.partitionBy("transaction_id").orderBy("effective_start_date", "effective_end_date")
    out = df.select("transaction_id", F.row_number().over(w).alias("version"), *HISTORY_COLUMNS)
    return out if transaction_id is None else out.orderBy("version")


def version_counts(curated: DataFrame) -> DataFrame:
    return curated.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("versions"))


def changed_fields(curated: DataFrame, tracked: Sequence[str] = C.SCD2_TRACKED_FIELDS) -> DataFrame:
    """Ids with more than one version, and which tracked fields took more
    than one value across them (NULL counts as a value)."""
    aggs = [F.count(F.lit(1)).alias("versions")]
    for c in tracked:
        some_null = (F.count(c) > 0) & (F.count(c) < F.count(F.lit(1)))
        aggs.append((F.coalesce(F.min(c) < F.max(c), F.lit(False)) | some_null).alias(f"_{c}_changed"))
    per_id = curated.groupBy("transaction_id").agg(*aggs).filter(F.col("versions") > 1)
    names = [F.when(F.col(f"_{c}_changed"), F.lit(c)) for c in tracked]
    return per_id.select("transaction_id", "versions", F.concat_ws(",", *names).alias("changed_fields"))


def curated_browse(
    curated: DataFrame,
    dates: Optional[Iterable] = None,
    statuses: Optional[Iterable[str]] = None,
    current_only: bool = True,
) -> DataFrame:
    """Conjunction of optional filters: business date set, status set,
    current versions only (on by default)."""
    df = curated
    if dates:
        df = df.filter(F.col("transaction_date").isin([F.lit(d).cast("date") for d in dates]))
    if statuses:
        df = df.filter(F.col("recon_status").isin(list(statuses)))
    if current_only:
        df = df.filter(F.col("is_current"))
    return df


def browse_stored_curated(
    spark: SparkSession,
    path: str,
    dates: Optional[Iterable] = None,
    statuses: Optional[Iterable[str]] = None,
    current_only: bool = True,
) -> DataFrame:
    """:func:`curated_browse` of the stored table. The folders of the chosen
    dates are picked from the pointer, and no other is listed or opened."""
    chosen = tables.read_curated(spark, path, dates or None)
    return curated_browse(chosen, None, statuses, current_only)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values of several columns at once, as
    ``(field, value)`` text: one scan, one partially aggregated shuffle. Not
    sorted; a list to choose from is :func:`pick_list`."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.explode(pairs).alias("p")).select("p.field", "p.value").filter(F.col("value").isNotNull()).distinct()


def pick_list(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-NULL values of one column (``value``). Only the
    distinct values are sorted."""
    return df.select(F.col(column).alias("value")).filter(F.col("value").isNotNull()).distinct().orderBy("value")
