"""Compression classifier: held-out accuracy and defined results for odd input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import quality as Q
from ledgerwise.llm.common import fold


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(12)
    syllables = ["the", "an", "ing", "er", "tion", "ou", "ble", "st", "re", "nd"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 4)))
    docs, labels = [], []
    for i in range(900):
        text = " ".join(word() for _ in range(rnd.randrange(20, 150)))
        bad = i % 4 == 0
        if bad:
            text = " | ".join(text.split()) if i % 8 else " ".join(f"{w}!!!" for w in text.upper().split())
        docs.append((i, text))
        labels.append((i, 0 if bad else 1))
    return docs, labels


@pytest.fixture(scope="module")
def tables(spark, data):
    return spark.createDataFrame(data[0], "doc_id long, text string"), spark.createDataFrame(data[1], "doc_id long, quality int")


@pytest.fixture(scope="module")
def model(tables):
    return Q.fit(*tables)


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    rows = Q.score(docs.withColumn("score", F.lit("clash")), model).join(labels, "doc_id").filter(fold(F.col("doc_id")) == Q.HELD_OUT).collect()
    assert np.mean([(r["score"] >= Q.ACCEPT) == bool(r["quality"]) for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_fit_is_repeatable_and_ignores_the_held_out_fold(tables, model):
    docs, labels = tables
    flipped = labels.withColumn("quality", F.when(fold(F.col("doc_id")) == Q.HELD_OUT, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = Q.fit(docs.repartition(5), flipped.repartition(3))
    assert again.good == model.good and again.bad == model.bad
    assert np.allclose(again.weights, model.weights)


def test_bound_of_the_sample(tables):
    small = Q.fit(*tables, dictionary_rows=40, calibration_rows=30)
    assert small.weights


def brute_score(text, model):
    """Whole windows one by one, each with a compressor of its own."""
    import math

    import zstandard

    def size(data, dictionary):
        own = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        return len(zstandard.ZstdCompressor(level=Q.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **own).compress(data))

    data = (text or "").encode()
    step = max(1, math.ceil(len(data) / max(1, math.ceil(len(data) / Q.WINDOW))))
    parts = [data[i : i + step] for i in range(0, len(data), step)] or [b""]
    good, bad = [size(p, model.good) for p in parts], [size(p, model.bad) for p in parts]
    differ = [(b - g) / max(b, g) for g, b in zip(good, bad)]
    weight = [max(1, len(p)) for p in parts]
    x = [sum(d * w for d, w in zip(differ, weight)) / sum(weight), min(differ), min(size(p, b"") / (len(p) + 64) for p in parts)]
    return 1 / (1 + math.exp(-(model.weights[0] + sum(a * b for a, b in zip(model.weights[1:], x)))))


def test_scores_by_brute_force(spark, data, model):
    texts = [t for _, t in data[0][:60]] + [None, "", "é" * 5000, " ".join(t for _, t in data[0][:80])]
    out = Q.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in out:
        assert r["score"] == pytest.approx(brute_score(r["text"], model), abs=1e-9)


def test_the_query_by_brute_force(spark, data, tmp_path):
    docs, labels = data
    odd = [(5000, None), (5001, ""), (None, "no id here"), (1, docs[1][1])]
    docs = spark.createDataFrame(docs + odd, "doc_id long, text string").withColumn("score", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    own = Q.fit(docs, labels)
    texts = {(r["doc_id"], brute_score(r["text"], own)) for r in docs.collect()}
    out = Q.op6_quality(spark, str(tmp_path)).collect()
    assert len(out) == 904
    near = {(i, round(s, 6)) for i, s in texts}
    for r in out:
        assert (r["doc_id"], round(r["score"], 6)) in near and r["predicted"] == (r["score"] >= Q.ACCEPT)


def test_repeated_ids_do_not_grow_the_sample(spark, tables, model):
    docs, labels = tables
    many = docs.unionByName(docs.filter("doc_id % 3 = 0").crossJoin(spark.range(20)).select("doc_id", "text"))
    again = Q.fit(many, labels.unionByName(labels))
    assert again.good == model.good and again.bad == model.bad and np.allclose(again.weights, model.weights)


def test_odd_texts(spark, model):
    texts = [None, "", "a", "😀", "x" * 2_000_000, "words " * 100, "words " * 100]
    out = Q.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    got = {r["doc_id"]: r["score"] for r in out}
    assert got[0] == got[1] and got[5] == got[6] and all(0 <= s <= 1 for s in got.values())
    assert Q.score(spark.createDataFrame([], "text string"), model).count() == 0


def test_missing_labels_give_the_share(spark, tables):
    docs, labels = tables
    assert Q.fit(docs, labels.limit(0)).prior == 0.5
    one = Q.fit(docs, labels.filter("quality = 1"))
    assert {r["score"] for r in Q.score(docs.limit(5), one).collect()} == {1.0}
    odd = spark.createDataFrame([(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    assert Q.fit(docs, labels.unionByName(odd).unionByName(labels)).weights


def test_windows_cover_the_text():
    for n in (0, 1, Q.WINDOW, Q.WINDOW + 1, 10 * Q.WINDOW + 3):
        data = bytes(i % 251 for i in range(n))
        parts = Q.windows(data)
        assert b"".join(parts) == data and max(map(len, parts)) <= Q.WINDOW
