"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are grouped by length: classes of a geometric grid, split by hash
into buckets of bounded size, so one class holding everything is many buckets.
A first pass scores every query against one bucket, the best-filled longest
one, and gives each query a lower bound for its k-th score. Then each block of
queries meets each bucket. With the bound theta, a query q and the bucket's
greatest length l, the local cosine threshold is t = theta / (|q| l):

- t > 1: the bucket cannot hold a result; the pair is dropped before anything is
  shuffled, and a bucket goes only to the blocks of queries that still ask it;
- t high: coordinate pruning. On q's largest coordinates a candidate of cosine
  t or more lies in a narrow range, and only those in all ranges are scored;
- else: length pruning. Candidates are sorted by length, and the prefix with
  |q| |p| >= theta is scored.

Scores are exact integer products. Bounds are widened by 1e-9, so rounding
never drops a candidate.
"""

from __future__ import annotations

import math
from typing import Iterator, List, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwise.llm.common import stage

GRID = 1.02
BUCKET_ROWS = 4096
BLOCK_ROWS = 512
#: Local threshold from which coordinates are worth looking at, and how many.
COORDINATE_FROM = 0.55
FOCUS = 6
SLACK = 1e-9
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    """Rows as float64, missing trailing components 0."""
    if len(vectors) and all(len(v) == dim for v in vectors):
        return np.stack([np.asarray(v, dtype="float64") for v in vectors])
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def products(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact integer products of integral float rows with q, as int64."""
    top = float(np.abs(p).max(initial=0.0)) * float(np.abs(q).max(initial=0.0)) * max(1, len(q))
    if top < 2**53:
        return (p @ q).astype("int64")  # every partial sum is an exact double
    exact = [sum(int(a) * int(b) for a, b in zip(row, q)) for row in p]
    return np.array([min(max(x, LONG_MIN), LONG_MAX) for x in exact], dtype="int64")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> Tuple[np.ndarray, np.ndarray]:
    if len(ids) > 4 * k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= kth
        ids, scores = ids[keep], scores[keep]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Bucket:
    """One bucket's candidates by length, descending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        order = np.argsort(-norms, kind="stable")
        self.ids, self.vectors, self.norms = ids[order], vectors[order], norms[order]
        with np.errstate(invalid="ignore", divide="ignore"):
            self.unit = np.nan_to_num(self.vectors / self.norms[:, None])

    def search(self, query_id: int, q: np.ndarray, k: int, theta: float) -> Tuple[np.ndarray, np.ndarray]:
        """The k best of the candidates that can reach theta, ties included."""
        rows = slice(None)
        length = math.sqrt(float(q @ q))
        bound = length * (self.norms[0] if len(self.norms) else 0.0)
        if theta > 0:
            if bound * (1 + SLACK) + SLACK < theta:
                return self.ids[:0], np.zeros(0, dtype="int64")
            local = theta / bound * (1 - SLACK) - SLACK
            if local >= COORDINATE_FROM:
                unit_q = q / length
                alive = np.ones(len(self.ids), dtype=bool)
                for f in np.argsort(-np.abs(unit_q))[:FOCUS]:
                    mid = unit_q[f] * local
                    wide = math.sqrt(max(0.0, 1 - unit_q[f] ** 2)) * math.sqrt(max(0.0, 1 - min(1.0, local) ** 2)) + 1e-7
                    # cosine in [local, 1] lies between the cone's edge and its far side
                    low = mid - wide if unit_q[f] > -local else -1.0
                    high = mid + wide if unit_q[f] < local else 1.0
                    alive &= (self.unit[:, f] >= low) & (self.unit[:, f] <= high)
                rows = np.flatnonzero(alive)
            else:
                rows = slice(0, int(np.searchsorted(-self.norms, -(theta / length) * (1 - SLACK) + SLACK, side="right")))
        ids, scores = self.ids[rows], products(self.vectors[rows], q)
        own = ids != query_id
        ids, scores = ids[own], scores[own]
        if theta > -math.inf:
            own = scores >= theta
            ids, scores = ids[own], scores[own]
        return best(ids, scores, k)


RESULT = "query_id long, vec_id long, score long"


def search_group(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: List[pd.DataFrame] = []
        if len(queries) and len(rows):
            dim = max(int(queries["vector"].map(len).max()), int(rows["vector"].map(len).max()))
            bucket = Bucket(rows["vec_id"].to_numpy("int64"), matrix(rows["vector"], dim))
            for query_id, q, theta in zip(queries["vec_id"], matrix(queries["vector"], dim), queries["theta"]):
                ids, scores = bucket.search(int(query_id), q, k, -math.inf if pd.isna(theta) else float(theta))
                found.append(pd.DataFrame({"query_id": np.int64(query_id), "vec_id": ids, "score": scores}))
        empty = pd.DataFrame({"query_id": np.zeros(0, "int64"), "vec_id": np.zeros(0, "int64"), "score": np.zeros(0, "int64")})
        return pd.concat(found) if found else empty

    return run


def ranked(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _length() -> Column:
    return F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))


def top_k(candidates: DataFrame, is_query: Column, k: int = 5, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``candidates(vec_id, vector)`` with
    integral double components; ``is_query`` marks the queries. A query never
    meets rows with its own vec_id. Ties go to the smaller vec_id.

    Rows with a null id, vector or component, or a non-finite component, take
    no part; a shorter vector counts as padded with zeros; a repeated row can
    be found twice, and a query id with several vectors asks with the least. Bucket and block counts come from one row count per length
    class, a table bounded by the range of doubles."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    rows = candidates.select("vec_id", "vector").filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.filter(finite)
    rows = rows.select("vec_id", "vector", F.floor(F.log(GRID, _length() + 1)).cast("int").alias("grade"), is_query.alias("asked"))
    rows = stage(rows, "vectors")

    grades = rows.groupBy("grade").agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked"))
    per_grade = [(r["grade"], r["n"], r["asked"]) for r in grades.orderBy(F.col("grade").desc()).collect()]
    n_queries = sum(r[2] for r in per_grade)
    blocks = max(1, -(-n_queries // block_rows))
    splits = {g: max(1, -(-n // bucket_rows)) for g, n, _ in per_grade}
    seed_grade = max(per_grade, key=lambda r: (min(r[1], bucket_rows), r[0]))[0] if per_grade else 0

    spread = F.lit(1)
    if splits:
        spread = F.element_at(F.create_map(*[F.lit(x) for item in splits.items() for x in item]), F.col("grade"))
    salted = F.pmod(F.xxhash64("vec_id", F.lit("bucket")), spread).cast("int")
    buckets = rows.withColumn("part", salted).select("vec_id", "vector", "grade", "part")
    queries = rows.filter("asked").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = queries.select("vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"))

    # a cogroup of two sides with one origin needs attributes of their own
    queries = queries.toDF(*queries.columns)

    # seed: the k-th score in one bucket
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    seed = buckets.filter((F.col("grade") == seed_grade) & (F.col("part") == 0)).select("vec_id", "vector", each_block)
    first = queries.withColumn("theta", F.lit(None).cast("double")).groupBy("block").cogroup(seed.groupBy("block")).applyInPandas(search_group(k), RESULT)
    theta = ranked(first, k).groupBy("query_id").agg(F.min("score").cast("double").alias("theta"), F.count(F.lit(1)).alias("found"))
    theta = theta.filter(F.col("found") == k).select(F.col("query_id").alias("vec_id"), "theta")
    bounded = stage(queries.join(theta, "vec_id", "left").withColumn("length", _length()), "bounds")
    longest = stage(buckets.groupBy("grade", "part").agg(F.max(_length()).alias("longest")), "lengths")  # a row per bucket

    every = F.explode(F.array(*[F.struct(F.lit(g).alias("grade"), F.lit(n).alias("parts")) for g, n in (splits or {0: 1}).items()]))
    asked = bounded.withColumn("to", every).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("to.parts") - 1)))
    asked = asked.select("vec_id", "vector", "theta", "length", "block", "to.grade", "part").join(longest, ["grade", "part"])
    bound = F.col("length") * F.col("longest") * (1 + SLACK) + SLACK
    asked = asked.filter(F.col("theta").isNull() | (F.col("theta") <= 0) | (bound >= F.col("theta")))
    keys = ["grade", "part", "block"]
    asked = asked.select("vec_id", "vector", "theta", *keys)
    wanted = asked.select(*keys).distinct()
    asked = asked.toDF(*asked.columns)
    offered = buckets.join(wanted, ["grade", "part"]).select("vec_id", "vector", *keys)
    hits = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInPandas(search_group(k), RESULT)
    return ranked(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_topk(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("vector")
    )
    return top_k(vectors, F.col("vec_id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
WHERE rank <= 5
"""
