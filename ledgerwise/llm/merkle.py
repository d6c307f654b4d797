"""Merkle manifest of a dataset with incremental witnesses.

Rows are leaves; every group of rows (a language) has a binary tree, and the
groups' roots have one more tree above them. A lone last node of a level is
hashed by itself.

Leaves are appended in order, in aligned blocks of 2**BLOCK_BITS. An append
completes subtrees: when a right sibling is complete, its digest extends the
witnesses of all leaves below the left one, and the left digest those of the
leaves below the right one. Open subtrees keep partial witnesses. Blocks are
independent of each other, so each is one small task; the root of a block is
then one further append to the tree above, whose witness extends those of all
leaves of the block, level by level up to the root of all groups.

Positions come without a global sort in one task: narrow leaves are range
partitioned, counted per partition and group, and the counts are summed up.
"""

from __future__ import annotations

import hashlib
from typing import Dict, List, Optional, Sequence, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwise.llm.common import stage

#: A block has 4096 nodes: some 100 bytes each, and a witness of 12 levels.
BLOCK_BITS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Sides of a sibling in a witness; a lone node has none.
NONE, LEFT, RIGHT = 0, 1, 2


def digest(data: bytes) -> bytes:
    """Lowercase hex sha256."""
    return hashlib.sha256(data).hexdigest().encode()


def leaf_digest(values: Sequence[Column]) -> Column:
    """H over the fields: ``-`` for null, else the UTF-8 byte count, ``:``, the value."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


# --- one block: streaming append ---------------------------------------------


class Appender:
    """Appends up to ``capacity`` nodes and keeps the witness of each.

    ``sides[level, i]`` and ``siblings[level, i]`` are the witness of node i as
    far as it is known; ``known[i]`` levels of it."""

    def __init__(self, capacity: int):
        levels = max(1, (capacity - 1).bit_length()) + 1
        self.sides = np.zeros((levels, capacity), "u1")
        self.siblings = np.zeros((levels, capacity), "S64")
        self.open: List[Tuple[int, int, bytes]] = []  # level, first node, digest of complete subtrees
        self.size = 0

    def append(self, node: bytes) -> None:
        self.open.append((0, self.size, node))
        self.size += 1
        self._join()

    def _join(self) -> None:
        """Complete siblings become their parent and extend witnesses."""
        while len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]:
            level, middle, right = self.open.pop()
            _, first, left = self.open.pop()
            self.sides[level, first:middle], self.siblings[level, first:middle] = RIGHT, right
            self.sides[level, middle : self.size], self.siblings[level, middle : self.size] = LEFT, left
            self.open.append((level + 1, first, digest(left + right)))

    def close(self, height: Optional[int] = None) -> Tuple[bytes, int]:
        """Root and height: lone nodes go up alone, until one node remains, or
        up to ``height`` (other blocks follow beside this one)."""
        while len(self.open) > 1 or height is not None and self.open[0][0] < height:
            level, first, node = self.open.pop()
            self.open.append((level + 1, first, digest(node)))
            self._join()
        return self.open[0][2], self.open[0][0]


def appended(nodes: Sequence[bytes], height: Optional[int]) -> Tuple[Appender, bytes, int]:
    block = Appender(len(nodes))
    if height is not None and height + 1 > len(block.sides):  # levels of lone nodes have no sibling
        more = height + 1 - len(block.sides)
        block.sides = np.pad(block.sides, ((0, more), (0, 0)))
        block.siblings = np.concatenate([block.siblings, np.zeros((more, len(nodes)), "S64")])
    for node in nodes:
        block.append(node)
    root, top = block.close(height)
    return block, root, top


Witness = List[Tuple[int, bytes]]


def witness(block: Appender, i: int, top: int) -> Witness:
    return list(zip(block.sides[:top, i].tolist(), block.siblings[:top, i].tolist()))


def fold(node: bytes, path: Witness) -> bytes:
    """The root that a leaf and a witness lead to."""
    for side, sibling in path:
        node = digest(node + sibling if side == RIGHT else sibling + node if side == LEFT else node)
    return node


def packed(path: Witness) -> bytes:
    return b"".join(bytes([side]) + sibling.ljust(64, b"\0") for side, sibling in path)


def unpacked(data: bytes) -> Witness:
    return [(data[i], data[i + 1 : i + 65].rstrip(b"\0")) for i in range(0, len(data), 65)]


# --- positions ----------------------------------------------------------------


def positions(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``nodes`` (``grp`` and more columns) plus ``pos`` (0.. in each group, by
    ``order``) and ``total`` (nodes of the group). Equal rows are interchangeable;
    a run of them is spread over range partitions by its place in the input."""
    cols = nodes.columns
    ranged = nodes.withColumn("__salt", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange("grp", *order, "__salt").sortWithinPartitions("grp", *order, "__salt")
    at = F.monotonically_increasing_id()  # partition number and row number of it
    ranged = stage(ranged.select(*cols, at.alias("__at")), "merkle-ranged").withColumn("__part", F.shiftright("__at", 33))
    runs = ranged.groupBy("grp", "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    w = Window.partitionBy("grp").orderBy("__part")  # one row for each range partition
    before = F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("grp", "__part", "__first", before.alias("__before"), F.sum("__n").over(Window.partitionBy("grp")).alias("total"))
    joined = ranged.join(runs, ["grp", "__part"])
    return joined.select(*cols, (F.col("__before") + F.col("__at") - F.col("__first")).alias("pos"), "total")


# --- trees over blocks ----------------------------------------------------------


def _blocks(nodes: DataFrame, bits: int) -> DataFrame:
    """``block`` and ``blocks`` (of the group) for nodes with pos and total."""
    return nodes.withColumn("block", F.shiftright("pos", bits)).withColumn("blocks", F.shiftright(F.col("total") - 1, bits) + 1)


def block_roots(nodes: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """grp, pos (of the block), total (blocks of the group), digest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        blocks = int(rows["blocks"].iloc[0])
        _, root, _ = appended([d.encode() for d in rows["digest"]], bits if blocks > 1 else None)
        return pd.DataFrame({"grp": rows["grp"].iloc[:1], "pos": rows["block"].iloc[:1], "total": blocks, "digest": root.decode()})

    own = _blocks(nodes.select("grp", "pos", "total", "digest"), bits)
    return own.groupBy("grp", "block").applyInPandas(run, "grp string, pos long, total long, digest string")


def node_paths(nodes: DataFrame, upper: Optional[DataFrame], bits: int = BLOCK_BITS) -> DataFrame:
    """grp, pos, path (packed witness up to the group's root): the witness in
    the block, extended by that of the block (``upper``: grp, pos, path)."""

    def run(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        block, _, top = appended([d.encode() for d in rows["digest"]], bits if int(rows["blocks"].iloc[0]) > 1 else None)
        rest = bytes(above["path"].iloc[0]) if len(above) else b""
        return pd.DataFrame({"grp": rows["grp"], "pos": rows["pos"], "path": [packed(witness(block, i, top)) + rest for i in range(len(rows))]})

    own = _blocks(nodes.select("grp", "pos", "total", "digest"), bits)
    if upper is None:
        upper = nodes.sparkSession.createDataFrame([], "grp string, pos long, path binary")
    return own.groupBy("grp", "block").cogroup(upper.groupBy("grp", "pos")).applyInPandas(run, "grp string, pos long, path binary")


def group_trees(nodes: DataFrame, bits: int = BLOCK_BITS) -> Tuple[DataFrame, Optional[DataFrame]]:
    """The groups' roots (grp, digest) and the witnesses of the blocks of
    ``nodes`` (grp, pos, path), None if every group is one block. Blocks of
    blocks are appended until every group is one: a level divides the nodes by
    2**bits, and only the largest group's number of blocks reaches the driver."""
    roots = stage(block_roots(nodes, bits), "merkle-blocks")
    if (roots.agg(F.max("total")).first()[0] or 1) <= 1:
        return roots.select("grp", "digest"), None
    tops, upper = group_trees(roots, bits)
    return tops, stage(node_paths(roots, upper, bits), "merkle-paths")


# --- the operator -----------------------------------------------------------------


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    presented: Optional[Dict[str, Column]] = None,
    with_proof: bool = False,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """One row per row of ``docs``: ``order``, leaf, subroot, root,
    proof_sha256, folded_root, verified, and with ``with_proof`` the ``proof``
    (array of side and digest, from the leaf to the root).

    ``presented`` replaces fields by other expressions: the leaf of that row is
    then folded with the original's witness, so verified tells whether what is
    presented is what the manifest holds. Null fields are hashed as ``-``; a null
    ``group`` is the first group, a null ``order`` comes first in its group, rows of
    one ``order`` go by their leaf, equal rows have a leaf each; an empty table
    stays empty; other columns are left out. Texts are read once and not shuffled."""
    value = {f: F.col(f) for f in fields}
    own = leaf_digest([value[f] for f in fields])
    shown = leaf_digest([(presented or value).get(f, value[f]) for f in fields])
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # sorts as the group does, null first
    kind = docs.schema[order].dataType
    leaves = docs.select(grp.alias("grp"), F.col(order).alias("key"), own.alias("digest"), (shown if presented else F.lit(None).cast("string")).alias("shown"))
    leaves = leaves.withColumn("shown", F.nullif(F.col("shown"), F.col("digest")))
    nodes = positions(stage(leaves, "merkle-leaves"), ["key", "digest"])

    subroots, upper = group_trees(nodes, bits)
    tops = positions(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("own"), "digest"), ["own"])
    tops = stage(tops, "merkle-subroots")
    root, above = group_trees(tops, bits)
    over = node_paths(tops, above, bits).withColumnRenamed("path", "over")
    # the whole way above a block: to its group's root, then to the root
    tops = tops.join(over, ["grp", "pos"]).join(root.select("grp", F.col("digest").alias("root")), "grp")
    tops = stage(tops.select(F.col("own").alias("grp"), F.col("digest").alias("subroot"), "root", "over"), "merkle-tops")
    if upper is None:
        upper = tops.select("grp", F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("path"))
    upper = upper.join(tops, "grp")

    def finish(rows: pd.DataFrame, up: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        block, _, top = appended([d.encode() for d in rows["digest"]], bits if int(rows["blocks"].iloc[0]) > 1 else None)
        up = up.iloc[0]
        rest = unpacked(bytes(up["path"]) + bytes(up["over"]))
        out: Dict[str, list] = {c: [] for c in ("proof_sha256", "folded_root", "proof")}
        for i, (leaf, shown) in enumerate(zip(rows["digest"], rows["shown"])):
            path = witness(block, i, top) + rest
            out["proof_sha256"].append(digest(b"".join(s for _, s in path)).decode())
            out["folded_root"].append(fold((leaf if shown is None else shown).encode(), path).decode())
            if with_proof:
                out["proof"].append([{"side": ("", "left", "right")[a], "digest": s.decode()} for a, s in path])
        frame = {"key": rows["key"], "leaf": rows["digest"], "subroot": up["subroot"], "root": up["root"]}
        frame.update({c: v for c, v in out.items() if c != "proof" or with_proof})
        return pd.DataFrame(frame)

    schema = "key string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    schema += ", proof array<struct<side: string, digest: string>>" * with_proof
    rows = _blocks(nodes.withColumn("key", F.col("key").cast("string")), bits)
    done = rows.groupBy("grp", "block").cogroup(upper.groupBy("grp", "pos")).applyInPandas(finish, schema)
    return done.select(
        F.col("key").cast(kind).alias(order), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), *["proof"] * with_proof,
    )


def tampered() -> Dict[str, Column]:
    """n_chars one higher in every row whose doc_id's crc32 is divisible by 7."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return {"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    """The manifest of ``documents`` and its check against a tampered copy;
    edge cases as in ``manifest``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    return manifest(docs, presented=tampered())


#: The same by level-wise grouping of all nodes.
SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(i))
),
hit AS (
  SELECT doc_id, xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT),
      lambda c, h: xor(c >> 8, t[(xor(c, h) & 255) + 1])), 4294967295::BIGINT) % 7 = 0 AS tampered
  FROM (SELECT DISTINCT doc_id FROM documents), crc_table
),
fields AS (
  SELECT d.doc_id, d.lang,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(d.source) || ':' || d.source, '-')
      || coalesce(strlen(d.lang) || ':' || d.lang, '-') AS head,
    n_chars, n_chars + CASE WHEN tampered THEN 1 ELSE 0 END AS n_shown,
    coalesce(strlen(d.text) || ':' || d.text, '-') AS tail
  FROM documents d LEFT JOIN hit h ON d.doc_id IS NOT DISTINCT FROM h.doc_id
),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(n_shown::VARCHAR) || ':' || n_shown, '-') || tail) AS shown
  FROM fields
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM leaves
),
nodes AS (
  SELECT g, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY g, level, n, pos // 2
),
subroots AS (SELECT g, level AS height, h AS subroot FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, g AS pos, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM tops WHERE n > 1 GROUP BY level, n, pos // 2
),
way AS (
  SELECT p.g, p.pos, s.level, (p.pos >> s.level) % 2 AS odd, b.h AS sibling
  FROM placed p JOIN (SELECT DISTINCT g, level FROM nodes WHERE n > 1) s USING (g)
  LEFT JOIN nodes b ON b.g = p.g AND b.level = s.level AND b.pos = xor(p.pos >> s.level, 1)
  UNION ALL
  SELECT p.g, p.pos, r.height + s.level, (p.g >> s.level) % 2, b.h
  FROM placed p JOIN subroots r USING (g) CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) s
  LEFT JOIN tops b ON b.level = s.level AND b.pos = xor(p.g >> s.level, 1)
),
folded AS (
  SELECT g, pos, 0 AS level, shown AS h FROM placed
  UNION ALL
  SELECT f.g, f.pos, f.level + 1, sha256(CASE WHEN sibling IS NULL THEN f.h WHEN odd = 1 THEN sibling || f.h ELSE f.h || sibling END)
  FROM folded f JOIN way w ON f.g = w.g AND f.pos = w.pos AND f.level = w.level
),
done AS (SELECT g, pos, arg_max(h, level) AS folded_root FROM folded GROUP BY g, pos),
proofs AS (SELECT g, pos, sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256 FROM way GROUP BY g, pos)
SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed p JOIN subroots USING (g) CROSS JOIN (SELECT h AS root FROM tops WHERE n = 1) JOIN done d ON d.g = p.g AND d.pos = p.pos
LEFT JOIN proofs q ON q.g = p.g AND q.pos = p.pos
"""
