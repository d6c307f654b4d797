"""Manifest against hashing level by level, witnesses at every stage of an append."""

import hashlib
import zlib

import pytest

from ledgerwise.llm import merkle
from tests.conftest import SF_SMALL
from tests.oracle_check import compare

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, pos):
    for nodes in tree[:-1]:
        yield pos % 2, nodes[pos ^ 1] if pos ^ 1 < len(nodes) else None
        pos //= 2


def brute_force(rows):
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees, own = [], []
    for lang in langs:
        leaves = sorted(((r[0] is not None, r[0] or 0, h("".join(map(field, r)))), r) for r in rows if r[2] == lang)
        trees.append(levels([x[0][2] for x in leaves]))
        own.append([x[1] for x in leaves])
    top = levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for g, (tree, rows) in enumerate(zip(trees, own)):
        for pos, row in enumerate(rows):
            path = [*way(tree, pos), *way(top, g)]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None
            node = h("".join(map(field, (*row[:3], row[3] + 1, row[4])))) if hit else tree[0][pos]
            for odd, sibling in path:
                node = h(node) if sibling is None else h(sibling + node if odd else node + sibling)
            root = top[-1][0]
            out.append((row[0], tree[0][pos], tree[-1][0], root, h("".join(s or "" for _, s in path)), node, node == root))
    return sorted(out, key=str)


ROWS = [
    *[(k, f"s{k % 3}", ["de", "en", "é", "zh"][k % 4], k, f"text {k}") for k in range(70)],
    (None, None, None, None, None), (None, "s", "en", 1, "no id"), (500, "s", "lone", None, ""), (500, "", "", 0, "empty names"),
    (501, "s", "en", 3, "twice"), (501, "s", "en", 3, "twice"), (501, "s", "en", 4, "same id"), (14, "s", "de", None, "tampered, but null"), (502, "s", "de", 9, "ü" * 200_000),
]


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_rows_against_brute_force(spark, bits):
    docs = spark.createDataFrame([(*r, "x", 1) for r in ROWS], COLUMNS + ", grp string, pos int").repartition(3)
    got = merkle.manifest(docs, presented=merkle.tampered(), bits=bits)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(ROWS)


def test_query_against_sql(spark):
    assert compare(spark, SF_SMALL, ["op12_merkle"], verbose=False)["op12_merkle"]["ok"]


@pytest.mark.parametrize("rows", [[], ROWS[:1]])
def test_empty_table_and_single_row(spark, tmp_path, rows):
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    got = merkle.op12_merkle(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == brute_force(rows)


def test_a_row_repeated_over_most_of_the_table(spark):
    rows = [(7, "s", "en", 1, "copy")] * 3000 + ROWS
    docs = spark.createDataFrame(rows, COLUMNS).repartition(4)
    got = merkle.manifest(docs, presented=merkle.tampered(), bits=5)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_force(rows)


def test_proofs_lead_to_the_root(spark):
    docs = spark.createDataFrame(ROWS, COLUMNS)
    for r in merkle.manifest(docs, with_proof=True, bits=3).collect():
        assert r["verified"]
        sides = {"": merkle.NONE, "left": merkle.LEFT, "right": merkle.RIGHT}
        assert merkle.fold(r["leaf"].encode(), [(sides[p["side"]], p["digest"].encode()) for p in r["proof"]]).decode() == r["root"]


def test_witnesses_grow_while_leaves_are_appended():
    """After every append the open subtrees are complete, and the partial
    witness of each leaf leads to the root of its subtree."""
    nodes = [merkle.digest(str(k).encode()) for k in range(37)]
    block = merkle.Appender(len(nodes))
    for n, node in enumerate(nodes, 1):
        block.append(node)
        assert [1 << level for level, _, _ in block.open] == [1 << b for b in range(6, -1, -1) if n >> b & 1]
        for level, first, root in block.open:
            for i in range(first, first + (1 << level)):
                assert merkle.fold(nodes[i], merkle.witness(block, i, level)) == root
    root, top = block.close()
    assert root.decode() == levels([x.decode() for x in nodes])[-1][0]
    assert all(merkle.fold(x, merkle.witness(block, i, top)) == root for i, x in enumerate(nodes))
    assert merkle.unpacked(merkle.packed(merkle.witness(block, 36, top))) == merkle.witness(block, 36, top)
