"""Packing: ids of the reference tokenizer, each in exactly one piece, and
sequences without gaps."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerwise.llm import packing as P
from ledgerwise.llm.vocab import default_path


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


ODD = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a \nb", "it's 'quoted' we'll", "x" * 300 + " y", "tab\tbed\x0bone", "nbsp here", "é ñ 中文 漢字", "emoji 😀 😀!",
       "<|endoftext|> in text", "1,234.5 %%% ### a$$$ b", "\n\n\n", "a b c", "word " * 50, "a\x1cb c"]


def test_ids_equal_the_tokenizer(tokenizer):
    encoder = P.Encoder(default_path("byte_bpe_50k.tiktoken"))
    rnd = random.Random(1)
    texts = ODD + ["".join(rnd.choice(ODD + [" ", ".", "\n"]) for _ in range(6)) for _ in range(300)]
    for _ in range(2):  # the second time from the cache
        for t in texts:
            assert np.frombuffer(encoder.ids(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_word_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "CACHED_WORDS", 50)
    encoder = P.Encoder(default_path("byte_bpe_50k.tiktoken"))
    encoder.ids(" ".join(f"w{i}" for i in range(500)).strip())
    assert len(encoder.later) <= 50


def test_tails_are_cut_into_reciprocals():
    for tail in range(P.CAPACITY):
        cuts = P.tail_pieces(tail)
        assert sum(cuts) == tail and len(cuts) <= 6
        assert all(P.CAPACITY % c <= P.CAPACITY // P.SLACK or c == P.CAPACITY // (P.CAPACITY // c) for c in cuts)


def check(rows, texts, tokenizer):
    places = defaultdict(list)
    docs = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append(r)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= P.CAPACITY
    for doc, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(docs.pop(doc), key=lambda r: r["start"]):
            own = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4")
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(own.tobytes()))
            at += r["length"]
        assert at == len(ids)
    assert not docs
    return places


def test_round_trip(spark, tokenizer):
    rnd = random.Random(3)
    texts = {i: " ".join(f"word{rnd.randrange(900)}" for _ in range(int(rnd.paretovariate(0.9) * 20) % 4000)) for i in range(400)}
    texts.update({1000 + i: t for i, t in enumerate(ODD)})
    texts[2000], texts[2001] = None, "long text " * 30_000
    df = spark.createDataFrame([(i, t, "s", 0) for i, t in texts.items()], "doc_id long, text string, start string, length int").repartition(4)
    rows = P.pack(P.token_pieces(df)).collect()
    places = check(rows, texts, tokenizer)
    used = sum(r["length"] for r in rows)
    assert used / (len(places) * P.CAPACITY) > 0.99
    assert sorted(map(str, P.pack(P.token_pieces(df.repartition(3))).collect())) == sorted(map(str, rows))


def test_odd_tables(spark, tokenizer):
    schema = "doc_id long, text string"
    assert P.pack(P.token_pieces(spark.createDataFrame([], schema))).count() == 0
    rows = P.pack(P.token_pieces(spark.createDataFrame([(None, "a b c"), (5, "same"), (5, "same"), (6, None)], schema))).collect()
    assert len(rows) == 4 and sum(r["length"] for r in rows) == 4 + 2 + 2 + 1
    large = 2**60 + 1
    rows = P.pack(P.token_pieces(spark.createDataFrame([(None, "a"), (large, "b")], schema).coalesce(1))).collect()
    assert {r["doc_id"] for r in rows} == {None, large}
    with_ids = P.token_pieces(spark.createDataFrame([(1, "a b")], schema), with_ids=True).first()
    assert list(with_ids["ids"]) == tokenizer.encode("a b").ids + [0]


def test_added_tokens_as_the_tokenizer_has_them_by_default(spark, tmp_path):
    default = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    added = P.added_tokens(default_path("byte_bpe_50k.json"))
    assert added == {"<|endoftext|>": 50256}
    encoder = P.Encoder(default_path("byte_bpe_50k.tiktoken"), added)
    end = "<|endoftext|>"
    rnd = random.Random(6)
    texts = ODD + [end, end * 3, f"end of text {end} next", f"a{end}b", f" {end} ", f"\n{end}\n\n", f"<|endoftext{end}|>", "<|endoftext|", end.upper(), f"{end[:-1]}{end}"]
    texts += ["".join(rnd.choice(ODD + [" ", ".", "\n", end, end]) for _ in range(6)) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(encoder.ids(t), "<u4").tolist() == default.encode(t, add_special_tokens=False).ids, repr(t)
    assert np.frombuffer(encoder.ids(f"end of text {end} next"), "<u4").tolist() == [437, 286, 2420, 220, 50256, 1306]

    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = P.op5_packing(spark, str(tmp_path)).collect()
    check(rows, dict(enumerate(texts)), default)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    check(corpus_pipeline.pack_sequences(spark, docs, "").collect(), dict(enumerate(texts)), default)
