"""Alignment against the tokenizers' own output and counting pair by pair."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerwise.llm import alignment
from tests.conftest import SF_SMALL

ODD = [
    (None, "a  b"), (-1, None), (-2, ""), (-3, " "), (-4, "x▁y z"), (-5, "<|endoftext|> <s> end </s><unk>"), (-5, "the the the\n\n the"),
    (-5, "the the the\n\n the"), (-6, "é 日本 \x00 \x1c 　 x"), (-7, "ab" * 3000), (-8, " lead and trail "), (-9, "the " * 5000 + "end"), (-10, "▁"),
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}}
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))

    def spans(tokens):
        ends = np.cumsum([len(t) for _, t in tokens]).tolist()
        return [(i, e - len(t), e) for (i, t), e in zip(tokens, ends)]

    def both(text):
        if not text:
            return None
        of_a = [(i, bytes(byte[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        if any(b"".join(t for _, t in side) != (" " + text).encode() for side in (of_a, of_b)):
            return None
        return spans(of_a), spans(of_b)

    return both


def brute_force(rows, both):
    found, documents = [], Counter()
    for doc_id, text in rows:
        sides = both(text)
        if sides is None:
            found.append((doc_id, None))
            continue
        a, b = sides
        links = [(x, y) for x, s, e in a for y, p, q in b if s < q and p < e] if len(a) < 3000 else sweep(a, b)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, last = [], 0
        by_end = [[[], []] for _ in cuts]
        for side, tokens in enumerate((a, b)):
            k = 0
            for i, _, e in tokens:
                while e > cuts[k]:
                    k += 1
                by_end[k][side].append(str(i))
        groups = ";".join(",".join(x) + "|" + ",".join(y) for x, y in by_end)
        documents.update(set(links))
        found.append((doc_id, (len(a), len(b), len(cuts), links, hashlib.sha256(groups.encode()).hexdigest())))
    highest = {}
    for (x, _), n in documents.items():
        highest[x] = max(highest.get(x, 0), n)
    out = Counter()
    for doc_id, got in found:
        if got is None:
            out[(doc_id, 0, 0, 0, 0, 0, 0, "")] += 1
        else:
            n_a, n_b, n_groups, links, sha = got
            best = sum(documents[p] == highest[p[0]] for p in links)
            out[(doc_id, n_a, n_b, n_groups, len(links), best, sum(documents[p] for p in links), sha)] += 1
    return out


def sweep(a, b):
    links, first = [], 0
    for x, s, e in a:
        while b[first][2] <= s:
            first += 1
        k = first
        while k < len(b) and b[k][1] < e:
            links.append((x, b[k][0]))
            k += 1
    return links


@pytest.mark.parametrize("chunk, links", [(1 << 13, 4_000_000), (1 << 13, 500)])
def test_rows_against_brute_force(spark, tokenizers, monkeypatch, chunk, links):
    monkeypatch.setattr(alignment, "LINKS", links)  # many chunks
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()] + ODD
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n_a int, chunk int").repartition(3)
    assert Counter(tuple(r) for r in alignment.align_documents(docs).collect()) == brute_force(rows, tokenizers)


def test_query_and_empty_table(spark, tmp_path, tokenizers):
    rows = ODD[:7]
    for name, some in (("full", rows), ("empty", [])):
        spark.createDataFrame(some, "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = alignment.op11_alignment(spark, f"{tmp_path}/{name}")
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert Counter(tuple(r) for r in got.collect()) == brute_force(some, tokenizers)


def test_planes_hold_every_link():
    """Popcounts and returned scores against counting, with dense and sparse
    planes and multiplicities up to hundreds."""
    rnd = np.random.default_rng(3)
    n = alignment.CHUNK
    keys = np.concatenate([np.full(n * 2, 5), rnd.integers(0, 50, 30_000), np.full(700, 99)])
    owners = np.concatenate([np.arange(n), rnd.integers(0, n, n), rnd.integers(0, n, 30_000), np.full(700, 17)])
    row = alignment.postings(keys, owners)
    links = Counter(zip(keys.tolist(), owners.tolist()))
    documents = Counter(k for k, _ in links)
    assert dict(zip(row["keys"].tolist(), row["docs"].tolist())) == documents
    assert len(row["sets"]) and len(row["lists"])
    score = rnd.integers(0, 1 << 40, len(row["keys"]))
    worth = dict(zip(row["keys"].tolist(), score.tolist()))
    want = np.zeros(n, "int64")
    for (k, d), times in links.items():
        want[d] += times * worth[k]
    assert np.array_equal(alignment.returned(row, score, n), want)
