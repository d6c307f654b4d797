"""Data-quality flagging, keep-latest dedup and the clean/quarantine split.

All operators are pure ``DataFrame -> DataFrame`` functions with no actions.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property
from typing import Union

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.functions import first_match, strict_date, strict_timestamp_ntz
from ledgerwise.operators.latest import keep_latest

RAW_DATE = "transaction_date_raw"
RAW_UPDATED_AT = "updated_at_raw"


def _date_lit(run_date: Union[date, str]):
    return F.lit(run_date if isinstance(run_date, str) else run_date.isoformat()).cast("date")


def dq_rules(run_date: Union[date, str]):
    """The ordered rule list; the first rule that holds names the flag.

    Expects ``transaction_date`` / ``updated_at`` already parsed (DATE /
    TIMESTAMP_NTZ, NULL when unparseable).
    """
    return [
        (F.col("transaction_id").isNull(), C.FLAG_NULL_ID),
        (F.col("amount").isNull() | (F.col("amount") <= 0), C.FLAG_NEGATIVE_AMOUNT),
        (
            F.col("transaction_date").isNull()
            | F.col("updated_at").isNull()
            | (F.col("transaction_date") > _date_lit(run_date)),
            C.FLAG_INVALID_DATE,
        ),
    ]


def apply_dq_rules(df: DataFrame, run_date: Union[date, str], keep_raw: bool = True) -> DataFrame:
    """Parse ``transaction_date`` / ``updated_at`` strictly and add ``dq_flag``.

    Exactly one flag per row, priority NULL_ID > NEGATIVE_AMOUNT >
    INVALID_DATE > OK; no row is dropped. With ``keep_raw`` the original text
    of both time columns is kept (``*_raw``) so quarantine payloads show what
    actually arrived.
    """
    extra = [c for c in df.columns if c not in C.TRANSACTION_COLUMNS]
    # The two parses run inside a one-element explode: a later filter on the
    # flag is not pushed below it, so the shape checks and casts run once per
    # row. Other columns pass through untouched (filters on them still reach
    # the scan).
    times = F.struct(
        strict_date("transaction_date").alias("d"), strict_timestamp_ntz("updated_at").alias("t")
    )
    step = df.select(*df.columns, F.explode(F.array(times)).alias("_parsed"))
    parsed = step.select(
        "transaction_id",
        "account_id",
        "amount",
        "currency",
        F.col("_parsed.d").alias("transaction_date"),
        "status",
        F.col("_parsed.t").alias("updated_at"),
        *extra,
        *(
            [F.col("transaction_date").alias(RAW_DATE), F.col("updated_at").alias(RAW_UPDATED_AT)]
            if keep_raw
            else []
        ),
    )
    return parsed.withColumn("dq_flag", first_match(dq_rules(run_date), C.FLAG_OK))


class DedupResult:
    """``kept``: the latest OK row per id. ``duplicates``: the other OK rows,
    flagged DUPLICATE. ``rejected``: rows flagged by an earlier rule. Plans
    are built on first access."""

    def __init__(self, split, rejected: DataFrame):
        self._split = split
        self.rejected = rejected

    @cached_property
    def kept(self) -> DataFrame:
        return self._split.winners.withColumn("dq_flag", F.lit(C.FLAG_OK))

    @cached_property
    def duplicates(self) -> DataFrame:
        return self._split.losers.withColumn("dq_flag", F.lit(C.FLAG_DUPLICATE))

    def all_rows(self) -> DataFrame:
        return self.kept.unionByName(self.duplicates).unionByName(self.rejected)

    def quarantine(self) -> DataFrame:
        return self.duplicates.unionByName(self.rejected)


def dedup_latest(flagged: DataFrame) -> DedupResult:
    """Among OK rows keep the latest ``updated_at`` per ``transaction_id``;
    the rest become DUPLICATE. Rows already flagged are untouched.

    Ties on ``updated_at`` are broken by every other column, so the survivor
    is a function of the input alone.
    """
    is_ok = F.col("dq_flag") == F.lit(C.FLAG_OK)
    ok = flagged.filter(is_ok).drop("dq_flag")
    # an OK row always has an id
    return DedupResult(keep_latest(ok, "transaction_id", ["updated_at"], null_keys=False), flagged.filter(~is_ok))


def apply_dedup(flagged: DataFrame) -> DataFrame:
    """Flagged rows in, the same rows out with losing OK rows re-flagged."""
    return dedup_latest(flagged).all_rows()


def dq_counts(flagged: DataFrame) -> DataFrame:
    """``dq_flag, n`` after dedup, without building the deduplicated rows: the
    OK rows that lose are all OK rows less the distinct OK ids."""
    is_ok = F.col("dq_flag") == F.lit(C.FLAG_OK)
    per_flag = flagged.groupBy("dq_flag").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(is_ok, F.col("transaction_id"))).alias("ids")
    )
    split = F.when(
        is_ok,
        F.array(
            F.struct(F.lit(C.FLAG_OK).alias("dq_flag"), F.col("ids").alias("n")),
            F.struct(F.lit(C.FLAG_DUPLICATE).alias("dq_flag"), (F.col("n") - F.col("ids")).alias("n")),
        ),
    ).otherwise(F.array(F.struct("dq_flag", "n")))
    return per_flag.select(F.explode(split).alias("c")).select("c.dq_flag", "c.n").filter(F.col("n") > 0)


def run_dq(df: DataFrame, run_date: Union[date, str]):
    """rules -> dedup -> split. Returns ``(clean, quarantine)``.

    ``clean`` comes straight from the per-id aggregation, so it is already
    hash-partitioned by ``transaction_id``.
    """
    result = dedup_latest(apply_dq_rules(df, run_date))
    return result.kept, result.quarantine()
