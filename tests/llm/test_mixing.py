"""Mixing: targets by resharing step by step, exact counts, and real texts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed=3, sources=("b", "a", "c", None, "é", "hot"), docs=240):
    rnd = random.Random(seed)
    rows = []
    for i in range(docs):
        source = "hot" if i % 3 == 0 else rnd.choice(sources)
        n = int(rnd.paretovariate(1.1) * 10) % 900
        rows.append((i, source, " ".join(f"w{i}_{j}" for j in range(n)) + rnd.choice(["", "\n", " \t"])))
    return rows + [(900, "tiny", "just three words"), (901, "void", None), (902, "a", ""), (None, "b", "no id here"), (903, "a", "twice the same"), (903, "a", "twice the same")]


def targets_by_steps(sizes, weights=M.WEIGHTS, cap=M.CAP):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(sizes), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not over:
            out.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


@pytest.mark.parametrize("block_words", [7, 256])
def test_report(spark, block_words):
    rows = corpus()
    df = frame(spark, rows).repartition(5)
    out = M.mix_report(df, block_words=block_words).collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets_by_steps(sizes)
    taken = Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= M.CAP * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = M.mix_report(frame(spark, rows[::-1]).repartition(3), block_words=block_words).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_targets_with_many_capped_sources(spark):
    sizes = {"a": 1, "b": 2, "c": 3, "d": 1000, "e": 5, "f": 0, None: 400}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in M.source_targets(df).collect()}
    assert got == pytest.approx(targets_by_steps(sizes))
    empty = M.source_targets(df.withColumn("size", F.lit(0).cast("long"))).collect()
    assert {r["target"] for r in empty} == {0.0}


def test_slots_use_each_block_once_per_epoch(spark):
    s = spark.createDataFrame([("x", 1000, 2350.0), ("y", 10, 4.0)], "source string, source_size long, target double")
    rows = M.slots(s, block_words=16, shards=5).collect()
    used = defaultdict(list)
    for r in rows:
        used[r["source"], r["epoch"]].append((r["block"], r["take"]))
    assert all(len({b for b, _ in own}) == len(own) for own in used.values())
    assert sum(t for _, t in used["x", 0]) == sum(t for _, t in used["x", 1]) == 1000
    assert sum(t for _, t in used["x", 2]) == 350 and sum(t for _, t in used["y", 0]) == 4
    shards = Counter(r["shard"] for r in rows if r["source"] == "x")
    assert len(shards) == 5 and min(shards.values()) > 10


@pytest.mark.parametrize("wanted", [{"a": 500, "b": 90, None: 410, "é": 7}, {"one": 3}, {}])
def test_shards_draw_their_source_counts(spark, monkeypatch, wanted):
    monkeypatch.setattr(M, "CHUNK", 16)
    df = spark.createDataFrame(list(wanted.items()) + [("void", 0)], "source string, n long")
    rows = [tuple(r) for r in M.dealt_slots(df, shards=7, seed=5).collect()]
    total = sum(wanted.values())
    used = defaultdict(list)
    for source, _, slot in rows:
        used[source].append(slot)
    assert {s: sorted(own) for s, own in used.items()} == {s: list(range(n)) for s, n in wanted.items()}
    got = Counter((shard, source) for source, shard, _ in rows)
    order = sorted(wanted, key=lambda s: (s is None, (s or "").encode()))
    drawn = Counter()
    for shard in range(7):
        size = total // 7 + (shard < total % 7)
        assert sum(n for (k, _), n in got.items() if k == shard) == size
        if size:
            odds = np.array([wanted[s] for s in order]) / total
            drawn.update({(shard, s): int(n) for s, n in zip(order, np.random.Generator(np.random.PCG64([5, shard])).multinomial(size, odds))})
    # only what is drawn beyond a source's number changes hands
    beyond = sum(max(0, sum(drawn[k, s] for k in range(7)) - wanted[s]) for s in order)
    assert sum((drawn - got).values()) <= beyond
    other = [tuple(r) for r in M.dealt_slots(df, shards=7, seed=6).collect()]
    assert len(wanted) < 2 or sorted(rows, key=str) != sorted(other, key=str)


def test_a_row_that_is_a_third_of_the_table(spark, monkeypatch):
    monkeypatch.setattr(M, "COPY_CHUNK", 9)
    rows = [(i, "s", " ".join(f"w{j}" for j in range(i % 13))) for i in range(200)] + [(7, "s", "the very same words")] * 100
    streams = M.word_streams(M.sized_documents(frame(spark, rows).repartition(4))).collect()
    assert len(streams) == 300 and len({(r["doc_id"], r["text_hash"], r["copy"]) for r in streams}) == 300
    at = 0
    for r in sorted((r for r in streams if r["size"]), key=lambda r: r["first_word"]):
        assert r["first_word"] == at
        at += r["size"]


def test_long_texts(spark):
    rows = [(1, "a", "word " * 300_000), (2, "b", "x" * 2_000_000), (3, None, "few words here")]
    out = M.mix_report(frame(spark, rows)).collect()
    assert {r["doc_id"]: r["size"] for r in out} == {1: 300_000, 2: 1, 3: 3}
    words = sum(len(WORD.findall(r["text"])) for r in M.mix_documents(frame(spark, rows)).collect())
    assert words == sum(r["taken"] for r in out)


def test_texts_hold_the_words_taken(spark):
    rows = corpus()
    df = frame(spark, rows).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("text_hash", F.lit("clash"))
    mixed = M.mix_documents(df, block_words=50)
    assert mixed.columns == df.columns
    words = Counter()
    originals = {i: Counter(WORD.findall(t or "")) for i, _, t in rows}
    for r in mixed.collect():
        own = WORD.findall(r["text"])
        assert own and not Counter(own) - originals[r["doc_id"]] and r["n_chars"] == len(r["text"]) and r["text_hash"] == "clash"
        words[r["doc_id"]] += len(own)
    want = Counter()
    for r in M.mix_report(df, block_words=50).collect():
        want[r["doc_id"]] += r["taken"]
    assert words == Counter({k: v for k, v in want.items() if v})
    assert M.mix_documents(df.limit(0)).count() == 0 and M.mix_report(df.limit(0)).count() == 0


def test_output_shards_hold_the_drawn_slots(spark):
    rows = corpus()
    df = frame(spark, rows).repartition(3)
    options = {"block_words": 20, "shards": 6}
    rows_of = lambda seed: [tuple(r) for r in M.mix_shards(df, seed=seed, **options).collect()]
    out = rows_of(7)
    assert {r[0] for r in out} == set(range(6))
    shards = [s for s, *_ in out]
    assert len([1 for a, b in zip([None] + shards, shards) if a != b]) == 6  # each shard in one piece
    for shard in range(6):
        own = [slot for s, slot, *_ in out if s == shard]
        assert own == sorted(own)
    sources = M.source_targets(M.sized_documents(df))
    plan = {(r["source"], r["slot"]): (r["shard"], r["epoch"], r["take"]) for r in M.slots(sources, 20, 6).collect()}
    held = Counter()
    texts = {(i, s): t for i, s, t in rows}
    for shard, slot, source, epoch, doc_id, lo, hi, text in out:
        assert plan[source, slot][:2] == (shard, epoch)
        assert WORD.findall(text) == WORD.findall(texts[doc_id, source])[lo:hi]
        held[source, slot] += hi - lo
    assert held == Counter({k: take for k, (_, _, take) in plan.items()})
    report = M.mix_report(df, **options).collect()
    places = sorted((r["doc_id"] or -1, r["source"] or "", *p) for r in report for p in r["places"])
    assert places == sorted((r[4] or -1, r[2] or "", r[0], r[1], r[5], r[6]) for r in out)
    assert sorted(out, key=str) == sorted(rows_of(7), key=str) != sorted(rows_of(8), key=str)
    assert Counter(r[0] for r in out) != Counter(r[0] for r in rows_of(8))  # the draw itself


def test_cut_words_keeps_blanks_inside():
    text = " a  b\tc\nd e "
    assert M.cut_words(text, [(0, 5)]) == text
    assert M.cut_words(text, [(1, 3)]) == "b\tc"
    assert M.cut_words(text, [(3, 5), (0, 2), (1, 2)]) == "a  b\nd e"


def test_texts_move_once_and_null_keys_meet(spark):
    rows = [(None, None, "a b c d e"), (None, None, "a b c d e"), (None, "s", "f g"), (3, None, "h i j"), (3, None, None), (4, "s", "k l m n")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, text string, extra string")
    mixed = M.mix_documents(df, block_words=2)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "cast(__key" not in plan
    want, got = Counter(), Counter()
    for r in M.mix_report(df, block_words=2).collect():
        want[r["doc_id"], r["source"]] += r["taken"]
    for r in mixed.collect():
        got[r["doc_id"], r["source"]] += len(WORD.findall(r["text"]))
        assert r["extra"] == "x"
    assert sum(want.values()) == 19 and any(i is None and s is None for i, s in got)
    assert got == Counter({k: v for k, v in want.items() if v})
