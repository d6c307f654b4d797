"""Prefix dynamic programming against tiktoken, edits against encoding anew."""

import hashlib
import random

import numpy as np
import pytest

from ledgerwise.llm import bpe, vocab

VOCABS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
ALPHABETS = ["ab", "aab ", " \n\t'sdl", "abcdefghij klmnop", "0123456789abcdef", "éßñ日本 ", "=-*_#. ", "ABCDEFGHxyz0123+/"]
ODD = ["", " ", "  a  b ", "it's we'll'", "\x00\x1c\x85　x", "<|endoftext|>", "a\r\n\r\n b", "日本語 text", "x" * 5000, "😀 é"]


def random_text(rnd, most):
    letters = "".join(rnd.sample(ALPHABETS, rnd.randint(1, 3)))
    return "".join(rnd.choice(letters) for _ in range(rnd.randint(0, most)))


@pytest.mark.parametrize("name", VOCABS)
def test_ids_are_those_of_tiktoken(name):
    path, rnd = vocab.default_path(name), random.Random(5)
    encoder, want = bpe.Encoder(bpe.vocabulary(path)), vocab.encoding(path)
    for text in ODD + [random_text(rnd, 150) for _ in range(3000)]:
        ids = encoder.ids(text)
        assert ids.tolist() == want.encode_ordinary(text), text
        assert encoder.decoded(ids) == text.encode()


def test_known_words_between_any_white_space():
    path, rnd = vocab.default_path(VOCABS[0]), random.Random(9)
    encoder, want = bpe.Encoder(bpe.vocabulary(path)), vocab.encoding(path)
    words = ["thhaanen", "thhaanen,", "it's", "éreen", "a1b", "Erti.\nOn", "", "z" * 80, "'s", "\x1c"]
    for _ in range(3000):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\n", " \n", "\t ", "\u3000", "\x85", ""]) for _ in range(rnd.randint(1, 8)))
        assert encoder.ids(text).tolist() == want.encode_ordinary(text), text


def test_a_match_is_encoded_once_in_a_worker(monkeypatch):
    encoder, asked = bpe.encoder(vocab.default_path(VOCABS[0])), []
    monkeypatch.setattr(encoder, "piece", lambda m, f=encoder.piece: asked.append(m) or f(m))
    first = encoder.ids("on qvathhaanen, qvathhaanen. qvathhaanen")
    again = bpe.encoder(vocab.default_path(VOCABS[0])).ids("on qvathhaanen. qvathhaanen, qvathhaanen")
    assert len(first) == len(again) and asked.count(" qvathhaanen") == 1


def test_every_prefix_has_its_own_last_token():
    path = vocab.default_path(VOCABS[0])
    v, want = bpe.vocabulary(path), vocab.encoding(path)
    data = b"antidisestablishmentarianisms"
    table = bpe.PrefixTable(v, data)
    for n in range(1, len(data) + 1):
        assert table.last[n - 1] == want._encode_single_piece(data[:n])[-1]
        assert bpe.PrefixTable(v, data[:n]).ids() == want._encode_single_piece(data[:n])


def test_appends_and_edits_of_a_table():
    v, rnd = bpe.vocabulary(vocab.default_path(VOCABS[0])), random.Random(6)
    for _ in range(200):
        data = bytes(rnd.choice(b"abcethinorgs") for _ in range(rnd.randint(0, 400)))
        table = bpe.PrefixTable(v, data[: len(data) // 2])
        table.append(data[len(data) // 2 :])
        assert table.last == bpe.PrefixTable(v, data).last
        for _ in range(3):
            a = rnd.randint(0, len(data))
            data = data[:a] + bytes(rnd.choice(b"abcethin") for _ in range(rnd.randint(0, 6))) + data[a + rnd.randint(0, 6) :]
            table.become(data)
            assert table.last == bpe.PrefixTable(v, data).last


def test_an_edit_recomputes_only_near_it(monkeypatch):
    v, rnd = bpe.vocabulary(vocab.default_path(VOCABS[0])), random.Random(7)
    data = bytes(rnd.choice(b"abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    table, asked = bpe.PrefixTable(v, data), []
    monkeypatch.setattr(v, "beside", lambda a, b, f=v.beside: asked.append(1) or f(a, b))
    table.become(data[:9000] + b"xyz" + data[9001:])
    assert 0 < len(asked) < 5000
    assert table.last == bpe.PrefixTable(v, data[:9000] + b"xyz" + data[9001:]).last


def test_edited_texts_are_encoded_as_if_anew():
    path, rnd = vocab.default_path(VOCABS[0]), random.Random(8)
    encoder, want = bpe.Encoder(bpe.vocabulary(path)), vocab.encoding(path)
    for k in range(800):
        text = random_text(rnd, 200)
        own = bpe.EncodedText(encoder, text, encoder.ids(text) if k % 2 else None)
        for _ in range(5):
            a, added = rnd.randint(0, len(own.text) + 2), random_text(rnd, rnd.choice([0, 1, 2, 20]))
            own.append(added) if rnd.random() < 0.3 else own.edit(a, a + rnd.choice([0, 0, 1, 2, 10]), added)
            assert own.ids().tolist() == want.encode_ordinary(own.text), own.text


ROWS = [(1, "plain words, again"), (2, None), (3, ""), (None, "no id"), (4, "the same"), (4, "the same"), (5, "long " * 40_000), (6, "z" * 30_000), *[(10 + k, t) for k, t in enumerate(ODD)]]


def test_query_rows(spark, tmp_path):
    want = vocab.encoding(vocab.default_path(VOCABS[0]))
    # columns that clash with those of the result
    rows = [(i, t, -1, "x") for i, t in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in bpe.op13_bpe(spark, str(tmp_path)).collect()), key=str)

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    ids = [(i, t or "", np.array(want.encode_ordinary(t or ""), "<u4")) for i, t in ROWS]
    assert got == sorted(((i, len(x), sha(x.tobytes()), sha(t.encode())) for i, t, x in ids), key=str)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = bpe.op13_bpe(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.collect() == []


def test_ids_decode_and_take_edits_on_spark(spark):
    want = vocab.encoding(vocab.default_path(VOCABS[0]))
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "x" * 1000)], "doc_id long, text string")
    encoded = bpe.encode(docs, with_ids=True)
    assert {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode(encoded).collect()} == {1: "one two three", 2: "", 3: "x" * 1000}
    edits = [(1, 2, 0, 3, "four"), (1, 1, 99, 99, " end"), (2, 1, 0, 0, "new"), (3, 1, 500, 501, None), (9, 1, 0, 0, "no such document"), (None, 1, 0, 0, "a")]
    got = bpe.reencode(encoded, spark.createDataFrame(edits, "doc_id long, seq int, start int, stop int, added string"))
    texts = {1: "four two three end", 2: "new", 3: "x" * 999}
    assert {r.doc_id: list(r.ids) for r in got.collect()} == {k: want.encode_ordinary(t) for k, t in texts.items()}
