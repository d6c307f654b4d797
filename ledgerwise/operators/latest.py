"""Keep the latest row per key, and return every other row as well.

* ``winners``: ``row_number() = 1`` over the key. Catalyst turns that filter
  into a group limit that also runs before the shuffle, so each map task ships
  at most one row per key, however hot. The result is hash-partitioned and
  sorted by ``key``, which the joins downstream reuse as it is.
* ``counted``: the winners and how many rows each key has, from one partial
  aggregate, for callers that need both.
* ``losers``: only keys seen more than once (one narrow, map-side combined
  count, or what the caller knows from ``counted``) enter; of a ``stored`` frame a
  filter of these keys drops the other rows before they are shuffled to the
  join that decides. Their rows are collapsed to distinct rows with a copy count,
  and ranked in two windows: per (key, salt), then among the best of each
  salt. So neither a hot key nor a large group of copies lands whole in one
  task, and no row is joined to its winner.

The order is total: the caller's order columns first, then every remaining
column, so the choice does not depend on partitioning or input order.
"""

from __future__ import annotations

from functools import cached_property
from typing import List, Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwise.operators import id_filter

# Copy counts above this are expanded in chunks spread over several tasks.
EXPAND_CHUNK = 1 << 20
# Parts that the distinct rows of one repeated key are ranked in.
SALTS = 64
# Bits of the filter of repeated keys, 8 MB at most: four million keys let one
# row in 16 pass by chance, and more keys only let more pass.
REPEATED_BITS = 1 << 26


class LatestSplit:
    """``winners`` and ``losers`` of :func:`keep_latest`; each plan is built
    on first access (a caller that needs only the winners never pays for the
    loser plan)."""

    def __init__(self, df: DataFrame, key: str, order_cols: Sequence[str], null_keys: bool = True, stored: bool = False):
        self._df, self._key, self._columns, self._null_keys, self._stored = df, key, df.columns, null_keys, stored
        self._ordered = list(order_cols) + [c for c in df.columns if c not in order_cols and c != key]
        self._latest_first: List[Column] = [F.col(c).desc_nulls_last() for c in self._ordered]

    @property
    def _keyed(self) -> DataFrame:
        return self._df.filter(F.col(self._key).isNotNull())

    @cached_property
    def winners(self) -> DataFrame:
        w = Window.partitionBy(self._key).orderBy(*self._latest_first)
        return self._keyed.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") == 1).select(*self._columns)

    @cached_property
    def counted(self) -> DataFrame:
        """The winners plus ``_rows``, the number of rows of their key. One pass:
        each map task keeps one row per key, and the result is partitioned and
        sorted by key like ``winners``."""
        ordered, key = self._ordered, self._key
        best = F.max(F.struct(*ordered)).alias("_best")
        per_key = self._keyed.groupBy(key).agg(best, F.count(F.lit(1)).alias("_rows"))
        return per_key.select(*[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in self._columns], "_rows")

    @cached_property
    def losers(self) -> DataFrame:
        return self.losers_among()

    def losers_among(self, repeated: Optional[DataFrame] = None) -> DataFrame:
        """All rows but the winners. ``repeated`` has the keys (one column of the
        key's name, each once) that have more than one row, if that is known."""
        key, columns = self._key, self._columns
        # On both sides the key travels under a second name: neither the
        # count's nor the join's partitioning by key is then taken over by what
        # follows, so AQE may split a hot key in the join, and the rows of a
        # key spread over tasks below it.
        named = self._keyed.select(*columns, F.col(key).alias("_key"))
        if repeated is None:
            repeated = named.groupBy(key, "_key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(F.col("_key").alias("_repeated"))
        else:
            repeated = repeated.select(F.col(key).alias("_repeated"))
        if self._stored:
            bitmap = id_filter.id_filter(repeated, "_repeated", REPEATED_BITS)
            named = id_filter.maybe_in(named, "_key", bitmap, REPEATED_BITS)
        rows = named.join(repeated, F.col(key) == F.col("_repeated"))
        rows = rows.select(*[F.col("_key").alias(c) if c == key else F.col(c) for c in columns])
        distinct = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))

        salted = distinct.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int"))
        w = Window.partitionBy(key, "_salt").orderBy(*self._latest_first)
        once = salted.withColumn("_rank", F.row_number().over(w))
        # the best of each salt meet in group 0; the rest has lost already
        group = F.when(F.col("_rank") == 1, F.lit(0)).otherwise(F.col("_salt") + 1)
        w = Window.partitionBy(key, "_group").orderBy(*self._latest_first)
        twice = once.withColumn("_group", group).withColumn("_rank", F.row_number().over(w))
        is_best = (F.col("_group") == 0) & (F.col("_rank") == 1)
        surplus = twice.select(*columns, (F.col("_copies") - is_best.cast("int")).alias("_surplus"))
        beaten = expand_copies(surplus, "_surplus")
        return beaten.unionByName(self._df.filter(F.col(key).isNull())) if self._null_keys else beaten


def expand_copies(df: DataFrame, count_col: str, chunk: int = EXPAND_CHUNK) -> DataFrame:
    """Turn ``(row, n)`` into ``n`` copies of ``row``; drops ``count_col``.

    Each row is first cut into ``ceil(n / chunk)`` chunk rows, the chunk rows
    are redistributed, and only then exploded into copies, so no single task
    emits more than ``chunk`` copies of one row. Only rows with ``n > 0``
    enter (callers pass surpluses of repeated keys, which are rare), so the
    redistribution moves little data.
    """
    columns = [c for c in df.columns if c != count_col]
    n = F.col(count_col)
    first = F.col("_c") * F.lit(chunk)
    last_chunk = F.floor((n - F.lit(1)) / F.lit(chunk)).cast("bigint")
    return (
        df.filter(n > 0)
        .select(*columns, n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_c"))
        .hint("rebalance")
        .select(*columns, F.explode(F.sequence(first + 1, F.least(first + chunk, F.col("_n")))).alias("_i"))
        .drop("_i")
    )


def keep_latest(df: DataFrame, key: str, order_cols: Sequence[str], null_keys: bool = True, stored: bool = False) -> LatestSplit:
    """Split ``df`` into the latest row per key and all remaining rows.

    ``winners`` and ``losers`` together have exactly the rows of ``df`` (as a
    bag). The latest is the greatest by ``order_cols``, then by all other
    columns; NULL order values lose to others. A NULL key matches nothing, so
    such rows never win and go to ``losers`` directly (they never form one
    oversized group); ``null_keys=False`` says that there are none, which
    saves the scan for them; ``stored=True``, that ``df`` is read from storage, so
    that reading it once more costs less than shuffling it. Columns must be groupable (no maps).
    """
    return LatestSplit(df, key, order_cols, null_keys, stored)
