"""Reconciliation of clean transactions against the ledger."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.functions import first_match, null_safe_differs
from ledgerwise.operators.latest import keep_latest


class LedgerSplit:
    """``unique``: one ledger row per non-NULL id. ``surplus``: every other
    row (extra rows of a repeated id, and rows without an id). Plans are
    built on first access."""

    def __init__(self, split):
        self._split = split

    @property
    def unique(self) -> DataFrame:
        return self._split.winners

    @property
    def surplus(self) -> DataFrame:
        return self._split.losers


def unique_ledger(ledger: DataFrame) -> LedgerSplit:
    """Keep one ledger row per id, deterministically (latest ``cleared_date``
    text, then all other columns). A NULL id can never match, so those rows
    go straight to ``surplus`` instead of forming one skewed group."""
    return LedgerSplit(keep_latest(ledger, "transaction_id", ["cleared_date"]))


def surplus_counts(ledger: DataFrame) -> DataFrame:
    """``dq_flag, n`` of the surplus ledger rows, by counting: rows without an
    id, and rows with one less the distinct ids."""
    one = ledger.agg(F.count(F.lit(1)).alias("rows"), F.count("transaction_id").alias("ids"), F.count_distinct("transaction_id").alias("unique"))
    flags = F.array(
        F.struct(F.lit(C.FLAG_NULL_ID).alias("dq_flag"), (F.col("rows") - F.col("ids")).alias("n")),
        F.struct(F.lit(C.FLAG_DUPLICATE).alias("dq_flag"), (F.col("ids") - F.col("unique")).alias("n")),
    )
    return one.select(F.explode(flags).alias("c")).select("c.dq_flag", "c.n").filter(F.col("n") > 0)


def recon_status(amount_tolerance: float = 0.0):
    """Priority UNRECONCILED > AMOUNT_MISMATCH > STATUS_MISMATCH > MATCHED.

    Comparisons are NULL-safe: NULL vs a value is a mismatch, NULL vs NULL a
    match. ``amount_tolerance`` (default exact) is an absolute difference.
    """
    p_amount, l_amount = F.col("amount"), F.col("ledger_amount")
    if amount_tolerance > 0:
        amount_differs = F.when(
            p_amount.isNotNull() & l_amount.isNotNull(), F.abs(p_amount - l_amount) > F.lit(amount_tolerance)
        ).otherwise(null_safe_differs(p_amount, l_amount))
    else:
        amount_differs = null_safe_differs(p_amount, l_amount)
    return first_match(
        [
            (F.col("_ledger_id").isNull(), C.RECON_UNRECONCILED),
            (amount_differs, C.RECON_AMOUNT_MISMATCH),
            (null_safe_differs("status", "ledger_status"), C.RECON_STATUS_MISMATCH),
        ],
        C.RECON_MATCHED,
    )


def reconcile(
    clean: DataFrame, ledger: DataFrame, amount_tolerance: float = 0.0, dedup_ledger: bool = True, carry: Sequence[str] = ()
) -> DataFrame:
    """Left-join clean transactions to the ledger on ``transaction_id`` and add
    ``recon_status``. Output: the seven transaction columns + ``recon_status``;
    ledger columns are not carried, further columns of ``clean`` only if named in
    ``carry``. Ledger-only ids are not reported.

    With ``dedup_ledger`` the ledger is first reduced to one row per id, so a
    repeated ledger id can never multiply transactions. The unique ledger is
    an aggregate keyed on ``transaction_id``; when ``clean`` is too (it is,
    coming from :func:`ledgerwise.operators.dq.run_dq`), the join needs no
    further exchange on either side.
    """
    right = unique_ledger(ledger).unique if dedup_ledger else ledger.filter(F.col("transaction_id").isNotNull())
    right = right.select(F.col("transaction_id").alias("_ledger_id"), "ledger_amount", "ledger_status")
    joined = clean.join(right, clean["transaction_id"] == right["_ledger_id"], "left")
    return joined.select(*[clean[c] for c in C.TRANSACTION_COLUMNS], recon_status(amount_tolerance).alias("recon_status"), *[clean[c] for c in carry])
