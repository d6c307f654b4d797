"""Near-duplicates against all pairs by counting shingles."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerwise.llm import near_dup as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text):
    w = WORD.findall(text or "")
    if not w:
        return Counter()
    return Counter([tuple(w)] if len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def similarity(a, b):
    common = sum((a & b).values())
    union = sum(a.values()) + sum(b.values()) - common
    return common / union if union else 0.0


def classes(rows, threshold=0.8):
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(i, t or "", bag(t)) for i, t in rows]
    for n, (i, t, a) in enumerate(bags):
        for j, u, b in bags[:n]:
            if t == u or similarity(a, b) >= threshold:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in rows}


def edited(rnd, words, n):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"new{rnd.randrange(10**6)}"
    return out


def corpus(seed, near=160, edits=5):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3000)}"
    base = [word() for _ in range(150)]
    texts = [" ".join(edited(rnd, base, rnd.randrange(1, edits))) for _ in range(near)]  # one large group, around the threshold
    for _ in range(40):
        own = [word() for _ in range(rnd.randrange(3, 90))]
        texts += [" ".join(own), " ".join(edited(rnd, own, 1)), "\n".join(own)]
    passage = [word() for _ in range(80)]
    texts += [" ".join(passage + [word() for _ in range(60)]) for _ in range(30)]  # a shared passage only
    texts += ["a b c d e f g " * 30, "a b c d e f g " * 36, "a b c d e f g " * 60, "x", "x", "x y", "", None, " \n\t"]
    rnd.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


def got(df):
    return {r["doc_id"]: r["class_id"] for r in N.near_duplicates(df).collect()}


def test_classes_equal_all_pairs(spark):
    rows = corpus(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = N.near_duplicates(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in out} == classes(rows)
    assert all(r["kept"] == (r["doc_id"] == r["class_id"]) for r in out)


def test_dense_blocks_equal_all_pairs(spark, monkeypatch):
    """Every block is verified as a whole, in several chunks."""
    monkeypatch.setattr(N, "PAIRS_PER_MEMBER", 0)
    monkeypatch.setattr(N, "BLOCK_MEMBERS", 16)
    rows = corpus(5, near=60, edits=12)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == classes(rows)


def test_odd_tables(spark):
    schema = "doc_id long, text string, sig string, bands int"
    assert N.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    long = "one two three four five six seven " * 20_000
    rows = [(None, "p q r s t u", "s", 1), (None, "p q r s t u", "s", 1), (5, long, "s", 1), (9, long + "eight", None, 1), (5, long, "s", 1),
            (7, "p q r s t u", None, None), (8, None, None, None), (4, "", None, None), (6, "p q r s t u", None, None), (6, "another text", None, None)]
    out = N.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in out) == sorted(
        [("None", "None")] * 2 + [("5", "5")] * 2 + [("9", "5"), ("7", "6"), ("8", "4"), ("4", "4")] + [("6", "6")] * 2
    )


def test_signatures_are_unbiased():
    rnd = random.Random(1)
    errors = []
    for _ in range(25):
        words = [f"w{rnd.randrange(400)}" for _ in range(120)] + [f"r{i % 9}" for i in range(60)]
        texts = [" ".join(words), " ".join(edited(rnd, words, rnd.randrange(1, 15)))]
        s = N.signatures(*N.bags(*N.shingles(texts)), 2, m=600)
        errors.append((s[0] == s[1]).mean() - similarity(*map(bag, texts)))
    assert abs(np.mean(errors)) < 0.02


def test_overlap_counts():
    rng = np.random.default_rng(3)
    bags = [np.unique(rng.integers(0, 300, rng.integers(1, 200))) for _ in range(70)]
    got = N.overlaps(np.repeat(np.arange(70), [len(b) for b in bags]), np.concatenate(bags), 70)
    want = [[len(np.intersect1d(a, b)) for b in bags] for a in bags]
    assert all(got[i][j] == want[i][j] for i in range(70) for j in range(70) if i != j)


@pytest.mark.parametrize("text", ["", "one", "one two three four", "one two three four five", "é   x y z q"])
def test_shingle_counts(text):
    owner, hashes = N.shingles(["lead in", text, None])
    assert (owner == 1).sum() == sum(bag(text).values())
    assert len(set(hashes[owner == 1])) == len(bag(text))
