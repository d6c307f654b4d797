"""Shared helpers: scratch tables, held-out folds, prefix sums, components."""

from __future__ import annotations

import ctypes
import uuid
from typing import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwise.sources.tables import scratch_root

#: The characters of ``[\x20\x09-\x0D]``.
BLANKS = " \t\n\x0b\x0c\r"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, survives lost executors, and columns can be pruned on reading.
    The files live as long as that folder; whoever owns it clears it."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Whole texts per Arrow batch. Spark's default of 10,000 rows is meant for
#: short rows; a batch of texts is held several times over by a Python worker.
TEXT_BATCH_ROWS = 1000


def give_back() -> None:
    """Hands memory that this Python worker has freed back to the machine. Spark
    keeps workers from stage to stage, and an allocator keeps what the largest
    batch took. Does nothing where the C library has no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches held to TEXT_BATCH_ROWS rows (a
    smaller setting stays): bounds what a Python worker holds of whole texts."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= TEXT_BATCH_ROWS:
        conf.set(key, str(TEXT_BATCH_ROWS))
    return df


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4; fold 2 is held out. A null id is in
    fold 0 (crc32 of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_offsets(counts: DataFrame, count: str, order: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """``counts`` plus ``first``: the sum of ``count`` over the rows before, in
    ``order``, inside each ``within`` group. ``counts`` is a small table of
    bucket totals whose size does not depend on the number of rows."""
    w = Window.partitionBy(*within) if within else Window.partitionBy()
    w = w.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("first", F.coalesce(F.sum(count).over(w), F.lit(0)).cast("long"))


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph, wholly in Spark.

    ``nodes(id)``, ``edges(a, b)`` with non-null ids; returns
    ``(id, component)`` with component = smallest id reachable. Alternates the
    large-star and small-star steps (every node of a neighbourhood is tied to
    its smallest member) until the edge set stops changing, which takes about
    log(n) rounds. Each round is one written table in the shared folder; only
    two sums reach the driver. A neighbourhood is reduced by min() with partial
    aggregation and joined back, so a hub is split by the join's skew handling.
    """
    e = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    e = stage(e.distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        # large star: neighbours larger than u are tied to the least of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        # small star: u and its smaller neighbours are tied to the least of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        e = stage(small, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "id")
    return nodes.join(roots, "id", "left").select("id", F.coalesce("m", "id").alias("component"))

