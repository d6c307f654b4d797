"""Sharding: a keyed permutation of global row numbers.

Rows get numbers 0..N-1, a Feistel network over Z_a x Z_b (a*b just over N)
permutes them, numbers that leave the range walk on along their cycle, and the
permuted number p gives ``shard = p mod S`` and ``slot = p div S``. Shard sizes
differ by one row at most, slots have no gaps, and any row's place follows
from its number and the key alone; nothing is shuffled by shard.

Numbering needs no global sort: rows fall into a fixed number of hash buckets,
the bucket totals are summed up to offsets, and rows count on inside their
bucket. Rows that are equal in every column are counted before the shuffle and
numbered as one run, so even a row repeated over a third of the table is one
row per task there; its run is written out in chunks, spread over the tasks.
"""

from __future__ import annotations

import math
from typing import Sequence, Tuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwise.llm.common import partitions, running_offsets

ROUNDS = 4
#: Hex digits of the bucket's hash: 16**3 buckets.
BUCKET_DIGITS = 3
#: Rows of one run that are written out at a time.
RUN_CHUNK = 10_000


def _digest(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def domain(n: int) -> Tuple[int, int]:
    """Sides (a, b) of a near-square grid that holds n numbers; fewer than a
    numbers of the grid are out of range."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _mixed(seed, rnd: int, half: Column, size) -> Column:
    key = F.concat(seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed)), F.lit(f":{rnd}:"))
    return _digest(F.concat(key, half.cast("string")), 15) % _lit(size)


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def feistel(x: Column, a, b, seed) -> Column:
    """One pass of the permutation of 0..a*b-1, with x = left * b + right. Each
    round adds a keyed hash of one half to the other, which can be undone.
    Sides and seed may be numbers or columns."""
    a, b = _lit(a), _lit(b)
    left, right = F.floor(x / b).cast("long"), x % b
    for rnd in range(ROUNDS):
        if rnd % 2 == 0:
            left = (left + _mixed(seed, rnd, right, a)) % a
        else:
            right = (right + _mixed(seed, rnd, left, b)) % b
    return left * b + right


def unfeistel(x: Column, a, b, seed) -> Column:
    """The inverse of ``feistel``."""
    a, b = _lit(a), _lit(b)
    left, right = F.floor(x / b).cast("long"), x % b
    for rnd in reversed(range(ROUNDS)):
        if rnd % 2 == 0:
            left = F.pmod(left - _mixed(seed, rnd, right, a), a)
        else:
            right = F.pmod(right - _mixed(seed, rnd, left, b), b)
    return left * b + right


def _walk(once, x: Column, n, a, b) -> Column:
    """Cycle walking: apply ``once`` until the number is below n. At most
    a*b - n < a numbers are out of range, so a walk is short; one longer than
    64 (its odds are below a**-64) stops the job instead of giving a wrong
    place."""
    n = _lit(n)
    steps = F.least(_lit(a) * _lit(b) - n, F.lit(64)).cast("int")
    first = once(x)
    walked = F.aggregate(
        F.sequence(F.lit(0), steps),
        first,
        lambda p, _: F.when(p < n, p).otherwise(once(p)),
        lambda p: F.when(p < n, p).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("long")),
    )
    return F.when(first < n, first).otherwise(walked)


def grid(n: Column) -> Tuple[Column, Column]:
    """``domain`` for a column of sizes (1 or more, below 2**52)."""
    a = (F.floor(F.sqrt((n - 1).cast("double"))) + 1).cast("long")
    return a, F.ceil(n / a).cast("long")


def permute(x: Column, n, seed) -> Column:
    """Permutation of 0..n-1; n a number or a column."""
    a, b = grid(n) if isinstance(n, Column) else domain(n)
    return _walk(lambda p: feistel(p, a, b, seed), x, n, a, b)


def unpermute(x: Column, n, seed) -> Column:
    """The inverse of ``permute``: walks the cycle backwards."""
    a, b = grid(n) if isinstance(n, Column) else domain(n)
    return _walk(lambda p: unfeistel(p, a, b, seed), x, n, a, b)


def _bucket(cols: Sequence[str]) -> Column:
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return _digest(key, BUCKET_DIGITS)


def number_rows(df: DataFrame, order_by: Sequence[str], chunk: int = RUN_CHUNK) -> DataFrame:
    """``df`` plus ``row_no``: 0..N-1 without gaps, the same on every run for
    the same rows. Order: bucket of the hash of ``order_by``, then
    ``order_by``, then the other columns. Columns must be groupable (no maps)."""
    cols = list(df.columns)
    rest = [c for c in cols if c not in order_by]
    totals = df.groupBy(_bucket(order_by).alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows"))
    firsts = running_offsets(totals, "__rows", ["__bucket"]).select("__bucket", F.col("first").alias("__first"))
    runs = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__bucket", _bucket(order_by))
    w = Window.partitionBy("__bucket").orderBy(*order_by, *rest).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__before", F.coalesce(F.sum("__copies").over(w), F.lit(0)).cast("long"))
    # firsts has one row per bucket, 16**BUCKET_DIGITS at most
    numbered = runs.join(F.broadcast(firsts), "__bucket")
    start = F.col("__first") + F.col("__before")
    cut = F.explode(F.sequence(start, start + F.col("__copies") - 1, F.lit(chunk).cast("long")))
    chunks = numbered.select(*cols, (start + F.col("__copies")).alias("__end"), cut.alias("__from"))
    chunks = chunks.repartition(partitions(df), "__from")
    return chunks.select(*cols, F.explode(F.sequence("__from", F.least(F.col("__from") + chunk, F.col("__end")) - 1)).alias("row_no"))


def shard_rows(df: DataFrame, order_by: Sequence[str], shards: int = 8, seed: int = 2001) -> DataFrame:
    """``df`` plus ``row_no``, ``shard`` (0..shards-1) and ``slot``.

    Nulls are values like any other; repeated rows get a place each; an empty
    table stays empty. Columns named row_no, shard or slot are replaced. The
    row count is the only value that reaches the driver."""
    df = df.drop("row_no", "shard", "slot")
    n = df.count()
    numbered = number_rows(df, order_by)
    place = permute(F.col("row_no"), n, seed)
    return (
        numbered.withColumn("__place", place)
        .withColumn("shard", (F.col("__place") % shards).cast("int"))
        .withColumn("slot", F.floor(F.col("__place") / shards).cast("long"))
        .drop("__place")
    )


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """Every document in one of 8 shards under law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(docs, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: The same places by brute force: one global row number, a recursive walk.
SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
),
docs AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
        lambda c, h: xor(c >> 8, t[(xor(c, h) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM documents, crc_table
),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY
      substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size, text_crc32)), 1, 3), doc_id, size, text_crc32) - 1 AS x,
    count(*) OVER () AS n
  FROM docs
),
grid AS (
  SELECT n, a, greatest(1, (n + a - 1) // a) AS b
  FROM (SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM (SELECT max(n) AS n FROM numbered))
),
walk AS (
  SELECT x, x AS p, 0 AS step FROM numbered
  UNION ALL
  SELECT x, l2 * b + r2, step + 1 FROM (
    SELECT *, (r1 + ('0x' || substr(md5('2001:3:' || l2), 1, 15))::BIGINT % b) % b AS r2 FROM (
    SELECT *, (l1 + ('0x' || substr(md5('2001:2:' || r1), 1, 15))::BIGINT % a) % a AS l2 FROM (
    SELECT *, (r0 + ('0x' || substr(md5('2001:1:' || l1), 1, 15))::BIGINT % b) % b AS r1 FROM (
    SELECT *, (p // b + ('0x' || substr(md5('2001:0:' || r0), 1, 15))::BIGINT % a) % a AS l1 FROM (
    SELECT x, p, step, a, b, p % b AS r0 FROM walk, grid WHERE step = 0 OR p >= n)))))
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % 8 AS INTEGER) AS shard, p // 8 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN (SELECT x, arg_max(p, step) AS p FROM walk GROUP BY x) USING (x)
"""
