"""Exact top-k against scoring everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import topk as K


def brute(ids, vectors, k=5):
    out = []
    dim = max(len(v) for v in vectors)
    full = [[int(x) for x in v] + [0] * (dim - len(v)) for v in vectors]
    for i, q in zip(ids, full):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in zip(ids, full) if j != i)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(3)
    return sorted(tuple(r) for r in K.top_k(df, F.col("vec_id") % 50 == 0, **options).collect())


@pytest.mark.parametrize("shape", ["even", "lengths", "ties"])
def test_equals_brute_force(spark, shape):
    rng = np.random.default_rng(7)
    n, dim = 700, 12
    v = np.floor(rng.normal(size=(n, dim)) * 40)
    if shape == "lengths":
        v = np.floor(v * rng.lognormal(0, 1.5, size=(n, 1)))
    if shape == "ties":
        v = np.floor(v / 60)
        v[:200] = v[0]
    rows = [(i, [float(x) for x in v[i]]) for i in range(n)]
    assert run(spark, rows, bucket_rows=64, block_rows=4) == brute(range(n), [r[1] for r in rows])


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [0.0, 0.0]), (3, [5.0]), (4, []), (7, [1e9, -1e9]), (100, [3e18, 3e18])]
    ids, vectors = zip(*rows)
    expected = brute(ids, vectors)
    bad = [(8, None), (9, [None, 1.0]), (10, [float("nan"), 1.0]), (11, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    got = run(spark, rows + bad)
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    assert all(g[3] == max(min(e[3], K.LONG_MAX), K.LONG_MIN) for g, e in zip(got, expected))
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    twice = run(spark, [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0])])
    assert twice == [(0, 1, 1, 2), (0, 2, 1, 2)]


def test_pruning_leaves_work_out():
    rng = np.random.default_rng(1)
    v = np.floor(rng.normal(size=(4000, 32)) * 100)
    b = K.Bucket(np.arange(4000), v)
    q = v[5] + 1
    ids, scores = b.search(-1, q, 5, float("-inf"))
    again = b.search(-1, q, 5, float(scores[-1]))
    assert list(again[0]) == list(ids) and list(again[1]) == list(scores)
    assert len(b.search(-1, q, 5, 1e12)[0]) == 0
