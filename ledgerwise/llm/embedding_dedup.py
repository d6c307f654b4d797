"""Embedding near-duplicates with small-world graphs per shard.

Vectors are dealt to shards of bounded size by a hash of their id, and each
shard builds a navigable graph. A vector within half the link angle of a graph
node is counted to it instead of becoming one: any two vectors of such a ball
are links by the triangle inequality, so a group of copies, however large, is
one node and is never expanded into pairs.

Every node is searched in every shard, within the angle at which its ball and
the other could still hold a link. Beams widen for nodes whose beam is full of
hits, and for the whole block until an audit passes: probes at exactly the
link angle from known nodes must be found. Two balls whose distance leaves no
doubt are linked as a whole; all others are compared vector by vector, in
blocks, in double precision. Components are united over nodes.

A shard is bounded by rows and by numbers. Its rows stream into one Python
worker and leave it in batches; its graph is cut into small pieces. The
queries of a shard are dealt to a few splits of many rows each: only a split gets
a copy of the graph, ahead of its queries, which stream past it.
"""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter
from typing import Iterator, List, Sequence, Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm import hnsw
from ledgerwise.llm.common import TEXT_BATCH_ROWS, connected_components, give_back, partitions, running_offsets, stage, text_batches

COSINE = 0.9
SHARD_ROWS = 65_536
SHARD_VALUES = 1 << 23  # rows x length; reached before SHARD_ROWS from length 129 on
MIN_SHARDS = 4
BLOCK_ROWS = 2_048  # queries of a split at least, where there are as many,
SPLIT_ROWS = 65_536  # and at most, about
PIECE_BYTES = 1 << 12  # some rows of text_batches at most
OUT_ROWS = 8_192
MAX_TASKS = 4_096
MEMBER_CHUNK = 512
FIRST_BEAM = 32
AUDIT_PROBES = 64
AUDIT_RECALL = 0.99
EPS = 1e-9

BUILT = "kind string, dim int, shard int, vec_id long, leader long, angle double, vector array<float>, piece int, graph binary"
BUILT_ARROW = pa.schema([
    ("kind", pa.string()), ("dim", pa.int32()), ("shard", pa.int32()), ("vec_id", pa.int64()), ("leader", pa.int64()), ("angle", pa.float64()),
    ("vector", pa.list_(pa.float32())), ("piece", pa.int32()), ("graph", pa.binary()),
])
PAIRS = "a long, b long, angle double, ra double, rb double"


def _runs(batches: Iterator[pa.RecordBatch], key: Sequence[str]) -> Iterator[Tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that agree in ``key``, by which the rows are sorted."""
    for batch in batches:
        if batch.num_rows:
            at = np.column_stack([batch.column(k).to_numpy() for k in key])
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                yield tuple(at[lo].tolist()), batch.slice(lo, hi - lo)


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim)


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def build_shards(cosine: float):
    """Each shard to its members (with their leader and the angle to it), its
    nodes (with the ball's radius and the vector) and the pieces of its graph,
    which has the ids and radii of the nodes too. Rows come sorted by dim, shard
    and vec_id; a worker holds one shard."""
    absorb = float(np.cos(np.arccos(cosine) / 2)) + EPS

    def batch(n: int, **columns) -> pa.RecordBatch:
        arrays = [columns.get(f.name) for f in BUILT_ARROW]
        arrays = [pa.nulls(n, f.type) if x is None else pa.repeat(pa.scalar(x, f.type), n) if isinstance(x, (str, int)) else pa.array(x, f.type) for x, f in zip(arrays, BUILT_ARROW)]
        return pa.RecordBatch.from_arrays(arrays, schema=BUILT_ARROW)

    def one(dim: int, shard: int, ids: np.ndarray, unit: np.ndarray) -> Iterator[pa.RecordBatch]:
        graph, node_row, leader, cos = hnsw.build(ids, unit, absorb)
        angle = np.where(leader == np.arange(len(ids)), 0.0, _angle(cos))
        radius = np.zeros(len(ids))
        np.maximum.at(radius, leader, angle)
        for lo in range(0, len(ids), OUT_ROWS):
            at = slice(lo, lo + OUT_ROWS)
            yield batch(len(ids[at]), kind="member", dim=dim, shard=shard, vec_id=ids[at], leader=ids[leader[at]], angle=angle[at])
        rows = max(1, min(OUT_ROWS, hnsw.CELLS // dim))
        for lo in range(0, len(node_row), rows):
            at = node_row[lo : lo + rows]
            vector = pa.ListArray.from_arrays(np.arange(0, len(at) * dim + 1, dim, dtype=np.int32), pa.array(unit[at].astype(np.float32).ravel()))
            yield batch(len(at), kind="node", dim=dim, shard=shard, vec_id=ids[at], leader=ids[at], angle=radius[at], vector=vector)
        data = memoryview(graph.dump(ids=ids[node_row], radii=radius[node_row]))
        del graph
        cuts = np.arange(0, len(data), PIECE_BYTES)
        for lo in range(0, len(cuts), TEXT_BATCH_ROWS):
            at = cuts[lo : lo + TEXT_BATCH_ROWS]
            yield batch(len(at), kind="graph", dim=dim, shard=shard, piece=lo + np.arange(len(at)), graph=[data[x : x + PIECE_BYTES] for x in at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, shard), rows in groupby(_runs(batches, ["dim", "shard"]), itemgetter(0)):
            ids, unit = zip(*((x.column("vec_id").to_numpy(), _vectors(x.column("unit"), dim)) for _, x in rows))
            ids, unit = np.concatenate(ids), np.concatenate(unit)
            yield from one(dim, shard, ids, unit)
            del ids, unit
            give_back()

    return run


def audit(graph: hnsw.Graph, beam: int, cosine: float) -> float:
    """Share of nodes that a probe at exactly the link angle finds. Probes
    point from hashed nodes into hashed directions: the same on every run."""
    rng = np.random.Generator(np.random.PCG64([graph.n, beam]))
    at = rng.integers(graph.n, size=min(AUDIT_PROBES, graph.n))
    base = graph.vectors[at].astype(np.float64)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(axis=1, keepdims=True) * base
    size = np.linalg.norm(away, axis=1, keepdims=True)
    probes = np.where(size > 1e-12, cosine * base + np.sqrt(1 - cosine**2) * away / np.maximum(size, 1e-12), base)
    ids, _ = graph.search(probes, beam)
    return float((ids == at[:, None]).any(axis=1).mean())


class Search:
    """The search of one graph: pairs of nodes (query < found or > found,
    deduplicated later) that may hold links, with the angle between them and
    both radii."""

    def __init__(self, graph: hnsw.Graph, cosine: float):
        self.graph, self.ids, self.radii = graph, graph.more["ids"], graph.more["radii"]
        self.link, self.beam = float(np.arccos(cosine)), FIRST_BEAM
        while self.beam < graph.n and audit(graph, self.beam, cosine) < AUDIT_RECALL:
            self.beam *= 2

    def pairs(self, ids: np.ndarray, unit: np.ndarray, ra: np.ndarray) -> Iterator[Tuple[np.ndarray, ...]]:
        """Columns a, b, angle, ra and rb, of a few queries at a time."""
        graph, beam, todo = self.graph, self.beam, np.arange(len(ids))
        widest = self.link + ra + float(self.radii.max())
        least = np.cos(np.minimum(widest, np.pi)) - 1e-6  # single precision of the search
        while len(todo):
            full = []
            step = max(1, min(hnsw.BATCH, hnsw.CELLS // min(beam, graph.n)))
            for lo in range(0, len(todo), step):
                own = todo[lo : lo + step]
                hit, sims = graph.search(unit[own], beam)
                inside = (hit >= 0) & (sims >= least[own, None])
                crowded = inside.all(axis=1) & (beam < graph.n)
                full.append(own[crowded])
                r, c = np.nonzero(inside & ~crowded[:, None])
                q, hit, sims = own[r], hit[r, c], sims[r, c]
                near = sims >= np.cos(np.minimum(self.link + ra[q] + self.radii[hit], np.pi)) - 2e-6
                near &= ids[q] != self.ids[hit]
                q, hit = q[near], hit[near]
                rows = max(1, hnsw.CELLS // unit.shape[1])
                for at in range(0, len(q), rows):
                    yield self._pairs(ids, unit, ra, q[at : at + rows], hit[at : at + rows])
            todo = np.concatenate(full)
            beam = beam * 2 if beam * 8 < graph.n else graph.n  # beyond that, the products of all nodes take less time

    def _pairs(self, ids, unit, ra, q, hit) -> Tuple[np.ndarray, ...]:
        # by the chord: single precision of the stored nodes stays well inside this margin, also of small angles
        chord = np.linalg.norm(unit[q].astype(np.float64) - self.graph.vectors[hit], axis=1)
        near = 2 * np.arcsin(np.minimum(chord / 2, 1.0))
        keep = near - ra[q] - self.radii[hit] <= self.link + 1e-4
        q, hit, near = q[keep], hit[keep], near[keep]
        a, b = ids[q], self.ids[hit]
        swap = a > b
        return (
            np.where(swap, b, a), np.where(swap, a, b), near,
            np.where(swap, self.radii[hit], ra[q]), np.where(swap, ra[q], self.radii[hit]),
        )


def search_splits(cosine: float):
    """Pairs of each split. Rows come sorted by split, first the pieces of the
    graph in order, then the queries; a worker holds one graph."""

    def one(rows: Iterator[Tuple[tuple, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
        pieces: List[pa.Buffer] = []
        search = None
        for _, batch in rows:
            n = batch.num_rows - batch.column("graph").null_count
            pieces += [x.as_buffer() for x in batch.column("graph").slice(0, n)]
            batch = batch.slice(n)
            if batch.num_rows:
                if search is None:
                    if not pieces:  # a shard without vectors has no graph
                        return
                    data, pieces = b"".join(pieces), []
                    search = Search(hnsw.Graph.load(data), cosine)
                    del data
                unit = _vectors(batch.column("vector"), search.graph.vectors.shape[1])
                for found in search.pairs(batch.column("vec_id").to_numpy(), unit, batch.column("angle").to_numpy()):
                    if len(found[0]):
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["a", "b", "angle", "ra", "rb"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groupby(_runs(batches, ["split"]), itemgetter(0)):
            yield from one(rows)
            give_back()

    return run


def compare_blocks(cosine: float):
    """Link counts between the two sides of every block: rows of kind ``count``
    (vec_id, n) and one of kind ``edge`` if there is a link at all. Rows come
    sorted by block; a side has about MEMBER_CHUNK vectors."""
    key = ["a", "b", "i", "j"]

    def flush(rows: List[pd.DataFrame]) -> pd.DataFrame:
        block = pd.concat(rows) if len(rows) > 1 else rows[0]
        left, right = block[block["side"] == 0], block[block["side"] == 1]
        a, b = int(block["a"].iloc[0]), int(block["b"].iloc[0])
        if not len(left) or not len(right):
            return pd.DataFrame({"vec_id": [], "n": [], "a": [], "b": []}).astype("int64")
        hit = _matrix(left["unit"]) @ _matrix(right["unit"]).T >= cosine
        n = np.concatenate([hit.sum(axis=1), hit.sum(axis=0)])
        ids = np.concatenate([left["vec_id"].to_numpy("int64"), right["vec_id"].to_numpy("int64")])
        return pd.DataFrame({"vec_id": ids[n > 0], "n": n[n > 0].astype("int64"), "a": a, "b": b})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: List[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            block = batch[key].to_numpy()
            cuts = [0, *(np.flatnonzero((block[1:] != block[:-1]).any(axis=1)) + 1), len(block)]
            done: List[pd.DataFrame] = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if waiting and (waiting[-1][key].iloc[0].to_numpy() != block[lo]).any():
                    done.append(flush(waiting))
                    waiting = []
                waiting.append(batch.iloc[lo:hi])
            if done:
                yield pd.concat(done)
        if waiting:
            yield flush(waiting)

    return run


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of
    ``vectors(vec_id, embedding)``: the number of other vectors at this cosine
    or more, the smallest id that links reach, and whether it is the own one.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing; vectors of different lengths never link. Rows sharing an
    id are one vector, the least of them; a null id has no links and a null
    component and is kept."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    largest = F.array_max(F.transform("vector", F.abs))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("vector"))
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0))
    usable = usable.filter(F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))).filter(largest > 0)
    usable = usable.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("top", largest)
    usable = usable.withColumn("vector", F.transform("vector", lambda v: v / F.col("top")))  # no overflow in the norm
    usable = usable.withColumn("norm", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)))
    unit = stage(usable.select("vec_id", F.size("vector").alias("dim"), F.transform("vector", lambda v: v / F.col("norm")).alias("unit")), "units")

    # one row per vector length; shards are numbered over all lengths and dealt by number
    dims = unit.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    enough = F.greatest(F.ceil(F.col("n") / shard_rows), F.ceil(F.col("n") * F.col("dim") / SHARD_VALUES))
    dims = dims.select("dim", F.greatest(F.lit(MIN_SHARDS), enough).cast("int").alias("shards"))
    dims = stage(running_offsets(dims, "shards", ["dim"]), "lengths")
    sharded = unit.join(dims, "dim").withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int"))
    sharded = _dealt(sharded.withColumn("number", F.col("first") + F.col("shard")), "number", dims.agg(F.sum("shards")).first()[0])
    sharded = sharded.select("dim", "shard", "vec_id", "unit").sortWithinPartitions("dim", "shard", "vec_id")
    built = stage(text_batches(sharded).mapInArrow(build_shards(cosine), BUILT), "graphs")

    # the queries of a shard in splits, each with a copy of the graph
    nodes = built.filter("kind = 'node'").select("dim", "vec_id", "angle", "vector")
    least_rows, n = F.ceil(F.col("nodes") / BLOCK_ROWS), F.ceil(F.lit(2 * partitions(unit)) / F.col("shards"))
    sizes = dims.drop("first").join(nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("nodes")), "dim")
    sizes = sizes.withColumn("splits", F.greatest(F.ceil(F.col("nodes") / SPLIT_ROWS), F.least(least_rows, n)).cast("int"))
    sizes = sizes.withColumn("all", F.col("shards").cast("long") * F.col("splits"))
    sizes = stage(running_offsets(sizes, "all", ["dim"]), "sizes")
    split = (F.col("first") + F.col("shard") * F.col("splits").cast("long") + F.col("part")).alias("split")
    asked = nodes.join(sizes, "dim").withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit("block")), F.col("splits")))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    asked = asked.select(split, F.lit(None).cast("int").alias("piece"), "vec_id", "angle", "vector", F.lit(None).cast("binary").alias("graph"))
    graphs = built.filter("kind = 'graph'").select("dim", "shard", "piece", "vec_id", "angle", "vector", "graph").join(sizes, "dim")
    graphs = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("splits") - 1)))
    met = asked.unionByName(graphs.select(split, "piece", "vec_id", "angle", "vector", "graph"))
    met = _dealt(met, "split", sizes.agg(F.sum("all")).first()[0])
    met = text_batches(met.sortWithinPartitions("split", F.col("piece").asc_nulls_last(), "vec_id")).mapInArrow(search_splits(cosine), PAIRS)
    met = stage(met.groupBy("a", "b").agg(F.min("angle").alias("angle"), F.first("ra").alias("ra"), F.first("rb").alias("rb")), "pairs")

    link = float(np.arccos(cosine))
    # the stored nodes are single precision: whoever is that close to the edge is compared
    sure = F.col("angle") + F.col("ra") + F.col("rb") <= F.lit(link - 1e-4)
    members = built.filter("kind = 'member'").select("vec_id", "leader")
    balls = members.groupBy("leader").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least"))

    # balls that lie wholly within the link angle
    whole = met.filter(sure).select("a", "b")
    both = whole.select(F.col("a").alias("leader"), F.col("b").alias("other")).unionByName(whole.select(F.col("b").alias("leader"), F.col("a").alias("other")))
    from_whole = both.join(balls.select(F.col("leader").alias("other"), "size"), "other").groupBy("leader").agg(F.sum("size").alias("n_whole"))

    # the rest, vector by vector
    parts = balls.select("leader", F.ceil(F.col("size") / MEMBER_CHUNK).cast("int").alias("parts"))
    doubt = met.filter(~sure).select("a", "b")
    doubt = doubt.join(parts.toDF("a", "pa"), "a").join(parts.toDF("b", "pb"), "b")
    doubt = doubt.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("pa") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)))
    chunked = members.join(parts, "leader").select("vec_id", "leader", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("chunk"))
    chunked = chunked.join(unit.select("vec_id", "unit"), "vec_id")
    sides = [
        doubt.join(chunked.toDF("vec_id", s, c, "unit"), [s, c]).select("a", "b", "i", "j", F.lit(n).alias("side"), "vec_id", "unit")
        for n, (s, c) in enumerate((("a", "i"), ("b", "j")))
    ]
    block = ["a", "b", "i", "j"]
    compared = sides[0].unionByName(sides[1]).repartition(partitions(unit), *block).sortWithinPartitions(*block)
    counted = stage(compared.mapInPandas(compare_blocks(cosine), "vec_id long, n long, a long, b long"), "counts")
    one_by_one = counted.groupBy("vec_id").agg(F.sum("n").alias("n_single"))

    edges = whole.unionByName(counted.select("a", "b").distinct())
    found = connected_components(balls.select(F.col("leader").alias("id")), edges).withColumnRenamed("id", "leader")
    least = found.join(balls, "leader").groupBy("component").agg(F.min("least").alias("component_id"))
    per_leader = found.join(least, "component").join(balls.select("leader", "size"), "leader").join(from_whole, "leader", "left")
    linked = members.join(per_leader.select("leader", "component_id", "size", "n_whole"), "leader").join(one_by_one, "vec_id", "left")
    linked = linked.select("vec_id", "component_id", (F.col("size") - 1 + F.coalesce("n_whole", F.lit(0)) + F.coalesce("n_single", F.lit(0))).alias("n_links"))
    out = rows.select("vec_id").join(linked, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _dealt(rows: DataFrame, number: str, count: int | None) -> DataFrame:
    """A task for each of ``count`` numbers, or for a few: by number, so that
    no two meet in a task by their hash, and AQE does not merge small ones."""
    tasks = max(1, min(count or 0, MAX_TASKS))
    return rows.repartitionById(tasks, F.pmod(number, F.lit(tasks)).cast("int"))


def op7_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


#: By brute force over all pairs, for small tables.
SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) >= {COSINE} * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))
),
reach AS (
  SELECT vec_id, vec_id AS seen FROM embeddings
  UNION
  SELECT vec_id, b FROM reach JOIN links ON seen = a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(seen) AS component_id FROM reach GROUP BY vec_id)
"""
