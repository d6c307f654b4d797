"""Quality classifier: which dictionary compresses a text better.

Two zstandard dictionaries are built from windows of good and of bad labelled
texts. A text is cut into windows of equal size; each is compressed with
either dictionary and without one. The normalised size differences (their mean
over the text, and the lowest window, which finds a bad passage in a good
text) and the plain ratio of the most compressible window go through a
logistic curve fitted on other labelled rows, weighted to the label shares.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from functools import lru_cache
from typing import Iterator, List, Optional, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwise.llm.common import fold, text_batches

#: Labelled rows per class for the dictionaries, and for the calibration.
DICTIONARY_ROWS = 1500
CALIBRATION_ROWS = 1000
#: Windows per row for the dictionaries, and bytes of a window.
ROW_WINDOWS = 3
WINDOW = 2048
DICTIONARY_BYTES = 65536
LEVEL = 3
HELD_OUT = 2
ACCEPT = 0.7


@dataclass(frozen=True)
class Model:
    """Dictionaries and logistic weights; without them (labels of one class, or
    none) every text gets the share of label 1."""

    good: bytes
    bad: bytes
    weights: Tuple[float, ...]
    prior: float


@lru_cache(maxsize=8)
def _compressor(dictionary: bytes):
    import zstandard

    options = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    own = zstandard.ZstdCompressionDict(dictionary)
    own.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=own, **options)


def windows(data: bytes) -> List[bytes]:
    n = max(1, -(-len(data) // WINDOW))
    step = max(1, -(-len(data) // n))
    return [data[i : i + step] for i in range(0, max(1, len(data)), step)]


def features(text: str, model: Model) -> Tuple[float, float, float]:
    """Mean and lowest normalised difference, and the lowest plain ratio."""
    data = (text or "").encode("utf-8", "surrogatepass")
    good, bad, plain = _compressor(model.good), _compressor(model.bad), _compressor(b"")
    total, lowest, least, n = 0.0, 1.0, 1.0, 0
    for w in windows(data):
        g, b = len(good.compress(w)), len(bad.compress(w))
        d = (b - g) / max(g, b, 1)
        total, n = total + d * max(1, len(w)), n + max(1, len(w))
        lowest = min(lowest, d)
        least = min(least, len(plain.compress(w)) / (len(w) + 64))
    return total / n, lowest, least


def probability(rows: np.ndarray, model: Model) -> np.ndarray:
    if not model.weights:
        return np.full(len(rows), model.prior)
    w = np.array(model.weights)
    z = np.clip(rows @ w[1:] + w[0], -30, 30)
    return 1 / (1 + np.exp(-z))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> Tuple[float, ...]:
    """Newton's method on standardised features, weights given back raw."""
    mean, std = x.mean(axis=0), x.std(axis=0) + 1e-9
    a = np.hstack([np.ones((len(x), 1)), (x - mean) / std])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + ridge * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    raw = w[1:] / std
    return (float(w[0] - (raw * mean).sum()), *[float(v) for v in raw])


def features_udf(model: Model):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([list(features(t, model)) for t in texts], dtype=object)

    return run


def fit(docs: DataFrame, labels: DataFrame, dictionary_rows: int = DICTIONARY_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """Fit on ``docs(doc_id, text)`` and ``labels(doc_id, quality)`` outside
    the held-out fold. At most ``dictionary_rows + calibration_rows`` rows per
    class, drawn by hash of the id; up to ROW_WINDOWS windows of each
    dictionary row, at hashed places, reach the driver. Of several rows under
    one id the least text and the least label count; null ids and other labels
    teach nothing."""
    import zstandard

    own = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT))
    own = own.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    shares = {r["quality"]: r["n"] for r in own.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(shares.values())
    prior = shares.get(1, 0) / total if total else 0.5
    if len(shares) < 2:
        return Model(b"", b"", (), prior)
    drawn = []
    for q in (0, 1):
        ids = own.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(dictionary_rows + calibration_rows)
        drawn += [(r["doc_id"], q, i) for i, r in enumerate(ids.select("doc_id").collect())]
    spark = docs.sparkSession
    # small classes: a third of the rows for the calibration
    size = {q: sum(d[1] == q for d in drawn) for q in (0, 1)}
    for_dict = {q: min(dictionary_rows, -(-2 * size[q] // 3)) for q in (0, 1)}
    ids = spark.createDataFrame([(d, q, i < for_dict[q]) for d, q, i in drawn], "doc_id long, quality int, for_dict boolean")
    # at most 2 * (dictionary_rows + calibration_rows) ids
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    sample = sample.groupBy("doc_id", "quality", "for_dict").agg(F.min("text").alias("text"))

    place = lambda i: F.pmod(F.xxhash64("doc_id", i), F.greatest(F.char_length("text") - WINDOW, F.lit(1))).cast("int") + 1
    cut = F.transform(F.sequence(F.lit(1), F.lit(ROW_WINDOWS)), lambda i: F.substring(F.col("text"), place(i), F.lit(WINDOW)))
    texts = sample.filter("for_dict").select("doc_id", "quality", F.array_distinct(cut).alias("cut")).collect()
    built = {}
    for q in (0, 1):
        rows = sorted((r for r in texts if r["quality"] == q), key=lambda r: r["doc_id"])
        parts = [w.encode("utf-8", "surrogatepass") for r in rows for w in r["cut"] if w]
        built[q] = _dictionary(parts)
    model = Model(built[1], built[0], (), prior)
    rows = text_batches(sample).filter(~F.col("for_dict")).select("doc_id", "quality", features_udf(model)("text").alias("x")).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["quality"]))
    y = np.array([r["quality"] for r in rows], dtype="float64")
    if len(set(y.tolist())) < 2:
        return Model(b"", b"", (), prior)
    x = np.array([r["x"] for r in rows])
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return Model(built[1], built[0], fit_logistic(x, y, weight), prior)


def _dictionary(parts: List[bytes]) -> bytes:
    """A trained dictionary; the windows themselves where they are too few to
    train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(parts)[-DICTIONARY_BYTES:]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``score``, the probability of label 1. Whole texts of any
    length are read; null counts as empty."""

    @F.pandas_udf(T.DoubleType())
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(probability(np.array([features(t, model) for t in texts]).reshape(-1, 3), model))

    return text_batches(docs).withColumn("score", run(F.col(text)))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Every document scored by the model of the labels outside the held-out fold.
    Null and empty texts have a score, repeated rows one each; without labels of
    both classes the score is the share of label 1 (0.5 without any)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
