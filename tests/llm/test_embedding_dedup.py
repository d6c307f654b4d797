"""Embedding near-duplicates against all pairs."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import embedding_dedup as E
from ledgerwise.llm import hnsw


def brute(ids, x, cosine=0.9):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= cosine
    np.fill_diagonal(hit, False)
    parent = list(range(len(ids)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in zip(*np.nonzero(hit)):
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    order = np.argsort(ids)
    rank = {int(v): i for i, v in enumerate(order)}
    smallest = {}
    for i in order:
        smallest.setdefault(find(i), int(ids[i]))
    assert rank
    return {int(ids[i]): (int(hit[i].sum()), smallest[find(i)]) for i in range(len(ids))}


def cloud(seed, spread):
    """Groups around the threshold, one of them large, and single vectors."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(250, 24))]
    for n in (180, 12, 7, 5, 3, 2):
        centre = rng.normal(size=24)
        parts.append(centre + spread * rng.normal(size=(n, 24)))
    line = rng.normal(size=24)
    step = rng.normal(size=24)
    parts.append(np.stack([line + 0.35 * i * step for i in range(9)]))  # a chain
    x = np.concatenate(parts)
    ids = rng.permutation(len(x)) * 3 + 2
    return ids, x * rng.uniform(0.1, 30, size=(len(x), 1))


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in E.near_duplicate_vectors(df).collect()}


@pytest.mark.parametrize("spread", [0.05, 0.3, 0.45])
def test_equals_all_pairs(spark, spread, monkeypatch):
    monkeypatch.setattr(E, "MEMBER_CHUNK", 32)
    ids, x = cloud(11, spread)
    assert run(spark, [(int(i), [float(c) for c in v]) for i, v in zip(ids, x)]) == brute(ids, x)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, []),
            (9, [1.0, 0.0, 0.0]), (10, [1e300, 0.0]), (11, [1e-300, 0.0]), (12, [1.0, 0.0])]
    got = run(spark, rows)
    assert all(got[i] == (4, 1) for i in (1, 2, 10, 11, 12))
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9))
    df = spark.createDataFrame([(None, [1.0]), (5, [1.0]), (5, [1.0])], "vec_id long, embedding array<double>")
    assert sorted(str(tuple(r)) for r in E.near_duplicate_vectors(df).collect()) == ["(5, 0, 5, True)"] * 2 + ["(None, 0, None, True)"]
    assert E.near_duplicate_vectors(df.limit(0)).count() == 0


def test_graph_recall():
    """Measured against brute force: at the link angle, and for the nearest."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, node_row, leader, _ = hnsw.build(np.arange(3000), x, 0.98)
    assert (leader >= 0).all() and graph.n == len(set(leader))
    assert E.audit(graph, E.FIRST_BEAM, 0.9) >= 0.95
    q = rng.normal(size=(200, 48))
    true = (q @ x[node_row].T).argmax(axis=1)
    for beam, least in ((128, 0.9), (graph.n, 1.0)):
        ids, _ = graph.search(q, beam)
        assert (ids == true[:, None]).any(axis=1).mean() >= least
    again = hnsw.Graph.load(graph.dump())
    assert np.array_equal(again.search(q, 64)[0], graph.search(q, 64)[0])


def test_copies_do_not_crowd_the_graph():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(50, 16))
    x = np.repeat(base, 60, axis=0) + 0.001 * rng.normal(size=(3000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph, _, _, cosine = hnsw.build(np.arange(3000), x, 0.975)
    assert graph.n == 50 and (cosine >= 0.975).all()


def built(ids, x, dim):
    """Rows of one shard, as the search gets them: pieces, then nodes."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    rows = pa.RecordBatch.from_pydict({
        "dim": pa.array([dim] * len(ids), pa.int32()), "shard": pa.array([0] * len(ids), pa.int32()),
        "vec_id": pa.array(ids, pa.int64()), "unit": pa.array(list(unit), pa.list_(pa.float64())),
    })
    batches = [rows.slice(lo, 100) for lo in range(0, len(ids), 100)]
    out = pa.Table.from_batches(E.build_shards(0.9)(iter(batches)))
    return [out.filter(pa.compute.equal(out["kind"], k)).combine_chunks() for k in ("graph", "node", "member")]


def test_a_graph_moves_in_pieces_to_few_splits(spark, monkeypatch):
    """As one row, copied to every block of 64 queries, it fills an executor."""
    kept, stage = {}, E.stage
    monkeypatch.setattr(E, "stage", lambda df, name: kept.setdefault(name, stage(df, name)))
    monkeypatch.setattr(E, "BLOCK_ROWS", 64)
    monkeypatch.setattr(E, "SHARD_ROWS", 128)
    ids, x = cloud(3, 0.45)
    assert run(spark, [(int(i), [float(c) for c in v]) for i, v in zip(ids, x)]) == brute(ids, x)
    graphs = kept["graphs"].filter("kind = 'graph'")
    shards = graphs.select("dim", "shard").distinct().count()
    assert graphs.agg(F.max(F.length("graph"))).first()[0] <= 4096 and graphs.count() > shards
    assert [(r["shards"], r["splits"]) for r in kept["sizes"].collect()] == [(shards, 2)]  # 2 x 4 partitions


def test_queries_stream_past_the_graph():
    ids, x = np.arange(600), np.random.default_rng(1).normal(size=(600, 16))
    x[1::2] = x[::2] + 0.25 * np.random.default_rng(2).normal(size=(300, 16))
    pieces, nodes, _ = built(ids, x, 16)
    both = pa.concat_tables([pieces, nodes]).combine_chunks()
    both = both.append_column("split", pa.array([7] * both.num_rows, pa.int64()))
    read = []

    def batches():
        for batch in both.to_batches(max_chunksize=50):
            read.append(batch.num_rows)
            yield batch

    found = E.search_splits(0.9)(batches())
    first = next(found)
    assert first.num_rows and sum(read) < pieces.num_rows + 150  # the rest is not read yet
    got = {(a, b) for out in [first, *found] for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist())}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    here = nodes["vec_id"].to_pylist()
    assert {(a, b) for a in here for b in here if a < b and unit[a] @ unit[b] >= 0.9} <= got
    assert sum(read) == both.num_rows


def test_a_crowd_within_reach_takes_bounded_memory():
    """Every node is within the widest reach of every other, as in a narrow cone."""
    rng = np.random.default_rng(4)
    axis = np.zeros(32)
    axis[0] = 1
    x = axis + rng.normal(size=(3000, 32)) * 0.072
    x[2900:] = x[:100] + rng.normal(size=(100, 32)) * 0.034
    pieces, nodes, members = built(np.arange(3000), x, 32)
    graph = hnsw.Graph.load(b"".join(pieces["graph"].to_pylist()))
    assert graph.more["ids"].tolist() == nodes["vec_id"].to_pylist() and members.num_rows == 3000
    search = E.Search(graph, 0.9)
    unit = graph.vectors.astype(np.float64)
    within = np.arccos(np.clip(unit @ unit.T, -1, 1))
    reach = search.link + graph.more["radii"]
    assert np.median((within <= reach.max() + graph.more["radii"][:, None]).mean(axis=1)) > 0.7
    want = within <= reach[:, None] + graph.more["radii"]
    tracemalloc.start()
    got = sum(int((out[0] != out[1]).sum()) for out in search.pairs(graph.more["ids"], graph.vectors, graph.more["radii"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert abs(got - (int(want.sum()) - graph.n)) <= 0.001 * got
    assert peak < 100e6  # 57 MB; 195 MB with all products of 256 queries at once
