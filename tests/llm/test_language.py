"""Word labels: exact posteriors, held-out accuracy, code-switched text."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwise.llm import language as L
from ledgerwise.llm.common import fold

SYLLABLES = {"aa": ["ka", "lo", "mi", "nu", "tor", "sha"], "bb": ["che", "ße", "ung", "ein", "keit", "ver"], "cc": ["ción", "ñe", "que", "ado", "lla", "ez"]}


def words(rnd, lang, n):
    return ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    langs = list(SYLLABLES)
    return [(i, " ".join(words(rnd, langs[i % 3], rnd.randrange(5, 80))), langs[i % 3]) for i in range(400)]


@pytest.fixture(scope="module")
def model(spark, rows):
    return L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


@pytest.mark.parametrize("lengths", [[1], [2, 5, 1], [0, 6, 3]])
def test_posteriors_equal_enumeration(lengths, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 2)
    rng = np.random.default_rng(1)
    k = 3
    a, s, em = rng.normal(size=(k, k)), rng.normal(size=k), rng.normal(size=(sum(lengths), k)) * 2
    got = L.posteriors(em, lengths, a, s)
    at = 0
    for n in lengths:
        e = em[at : at + n]
        want = np.zeros((n, k))
        for path in itertools.product(range(k), repeat=n):
            if path:
                score = s[path[0]] + sum(e[t, y] for t, y in enumerate(path)) + sum(a[x, y] for x, y in zip(path, path[1:]))
                for t, y in enumerate(path):
                    want[t, y] += np.exp(score)
        if n:
            assert np.allclose(got[at : at + n], want / want.sum(axis=1, keepdims=True))
        at += n


def test_chunks_make_no_difference(monkeypatch):
    rng = np.random.default_rng(2)
    lengths = [200, 1, 33, 64, 0, 7]
    em, a, s = rng.normal(size=(sum(lengths), 4)) * 3, rng.normal(size=(4, 4)), rng.normal(size=4)
    one = L.posteriors(em, lengths, a, s)
    monkeypatch.setattr(L, "CHUNK", 500)
    assert np.allclose(one, L.posteriors(em, lengths, a, s))


def test_held_out_accuracy(spark, rows, model):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = L.identify(df.withColumn("score", F.lit("clash")), model).filter(fold(F.col("doc_id")) == L.HELD_OUT).collect()
    assert len(out) > 60
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_code_switched_text_is_split(spark, model):
    rnd = random.Random(9)
    first, second = " ".join(words(rnd, "aa", 30)), " ".join(words(rnd, "cc", 30))
    df = spark.createDataFrame([(f"{first} {second}",)], "text string")
    spans = L.language_spans(df, model).first()["spans"]
    assert [s["lang"] for s in spans] == ["aa", "cc"]
    assert abs(spans[0]["end"] - len(first)) < 25 and spans[1]["end"] == len(first) + 1 + len(second)


def test_only_the_text_counts(spark, rows, model):
    df = spark.createDataFrame(rows[:50], "doc_id long, text string, lang string")
    moved = df.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit("zz"))
    key = lambda d: sorted((r["text"], r["lang_pred"], r["score"]) for r in L.identify(d, model).collect())
    assert key(df) == key(moved)


def test_held_out_labels_are_not_learned(spark, rows):
    wrong = [(i, t, lang if i % 2 else "zz") for i, t, lang in rows]
    df = spark.createDataFrame(wrong, "doc_id long, text string, lang string")
    held = df.withColumn("lang", F.when(fold(F.col("doc_id")) == L.HELD_OUT, F.lit("only-here")).otherwise(F.col("lang")))
    assert "only-here" not in L.fit(held).languages


def test_labels_without_words_are_left_out(spark, rows, model):
    kept = [i for i in range(9000, 9040) if zlib.crc32(str(i).encode()) % 4 != L.HELD_OUT]
    junk = [(i, t, lang) for i, t, lang in zip(kept, ["12345", "12345", "", "--- 7 ---", None], ["zxx", "zxx", "aa0", "und", "no"])]
    df = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    assert {"zxx", "und"} <= {lang for lang, _ in L.training_segments(df)}
    got = L.fit(df)
    assert got.languages == model.languages and np.array_equal(got.weights, model.weights) and np.array_equal(got.transitions, model.transitions)
    whole = corpus_pipeline.identify_language(spark, df, "")
    assert {r["doc_id"] for r in whole.select("doc_id").collect()} == {i for i, _, _ in rows}
    only = spark.createDataFrame(junk, "doc_id long, text string, lang string")
    assert L.fit(only).languages == ()


def test_repeated_ids_are_one_document(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    once = L.training_segments(df, 40)
    hot = [rows[9]] * 4000
    many = spark.createDataFrame(rows + hot, "doc_id long, text string, lang string").repartition(5)
    assert L.training_segments(many, 40) == once
    assert {lang for lang, _ in once} == set(SYLLABLES)
    nameless = [(None, t, lang) for _, t, lang in rows]
    found = L.training_segments(spark.createDataFrame(nameless, "doc_id long, text string, lang string"), 40)
    assert len({s for _, s in found}) > 60


def test_odd_texts(spark, model):
    long = "ka lo mi " * 60_000  # longer than a block
    texts = [None, "", "123 !!", "\x00", "É", "ka", "İİ ka lo", "x" * 300_000, long, long]
    out = L.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert [got[i] for i in range(4)] == [(L.UNKNOWN, 0.0)] * 4
    assert all(got[i][0] in model.languages for i in range(4, 10))
    assert got[8] == got[9] and got[8][0] == "aa"
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert L.identify(empty, L.fit(empty)).count() == 0
    alone = L.fit(spark.createDataFrame([(i, "one language", "aa") for i in range(9)], "doc_id long, text string, lang string"))
    assert alone.languages == ("aa",)


def test_long_texts_in_blocks_equal_one_piece(model, monkeypatch):
    rnd = random.Random(3)
    text = " ".join(words(rnd, "aa", 400) + words(rnd, "bb", 400))
    whole = [p.mean(axis=0) for _, _, _, p in L.label_texts([text], model)][0]
    monkeypatch.setattr(L, "BLOCK_CHARS", 500)
    assert np.allclose([p.mean(axis=0) for _, _, _, p in L.label_texts([text], model)][0], whole)
