"""The pipeline: every stage on all its predecessor kept, against plain rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerwise.llm import registry
from ledgerwise.llm.common import stage
from tests.conftest import SF_SMALL
from tests.llm.test_line_dedup import by_hand
from tests.llm.test_near_dup import classes
from tests.oracle_check import compare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, __x int, words string, sig string, slot int, length string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = {"aa": ["ka", "lo", "mi", "nu", "tor"], "bb": ["che", "ung", "ein", "keit", "ver"]}


def documents():
    rnd = random.Random(21)
    rows = []
    for i in range(90):
        lang = "ab"[i % 2] * 2
        lines = [" ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(rnd.randrange(6, 30))) for _ in range(rnd.randrange(1, 5))]
        rows.append([i, "\n".join(lines), lang, f"s{i % 3}"])
    base = ["".join(rnd.choice(SYLLABLES["aa"]) for _ in range(3)) for _ in range(90)]
    for i in range(90, 100):  # near copies of one text, without a shared line
        words = list(base)
        words[5 + i % 10] = f"new{chr(97 + i - 90)}"
        rows.append([i, " ".join(words), "aa", "s1"])
    rows.append([100, rows[7][1], "bb", "s2"])
    rows += [[101, "12345 67890", "aa", "s0"], [102, None, None, None], [103, "", "bb", "s1"], [None, "kalomi tornu lolo", None, "s2"], [5, rows[5][1], "bb", "s2"]]
    return [(i, t, lang, s, len(t or ""), "clash", 1, None, "c", None, "c") for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.createDataFrame(documents(), SCHEMA).repartition(3)
    out = [("documents", docs)]
    for name, f in P.STAGES:
        out.append((name, stage(f(spark, out[-1][1], "unused"), name)))
    return dict(out)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns_are_kept(steps):
    for name, _ in P.STAGES[:-1]:
        assert steps[name].columns == steps["documents"].columns


def test_language_stage_rejects_only_texts_without_language(steps):
    before, after = pairs(steps["documents"]), pairs(steps["language_id"])
    assert sorted(map(str, set(before) - set(after))) == sorted(map(str, {(101, "12345 67890"), (102, None), (103, "")}))
    assert len(after) == len(before) - 3
    assert steps["language_id"].filter("lang is null").count() == 0


def test_line_stage(steps):
    want = by_hand(pairs(steps["language_id"]))
    got = [(r["doc_id"], r["text"]) for r in steps["line_dedup"].collect()]
    assert sorted(str(g) for g in got) == sorted(str((eval(w)[0], eval(w)[1])) for w in want)
    assert steps["line_dedup"].filter(F.char_length("text") != F.col("n_chars")).count() == 0


def test_near_duplicate_stage(steps):
    before = [p for p in pairs(steps["line_dedup"]) if p[0] is not None]
    kept = [i for i, _ in pairs(steps["near_dup"])]
    want = set(classes(list(dict(before).items())).values())
    assert sorted(i for i in kept if i is not None) == sorted(want) and kept.count(None) == 1
    assert not set(range(91, 100)) & set(kept)


def test_texts_under_one_id_are_units(spark):
    words = [f"w{k}" for k in range(60)]
    one, other = " ".join(words[:30]), " ".join(words[30:])
    rows = [(5, one), (5, other), (5, other), (7, other + " more"), (8, "alone and short"), (9, None), (9, "text beside null"), (None, one)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(pairs(P.drop_near_duplicates(spark, docs, "unused")), key=str)
    kept = [t for _, t in got]
    assert kept.count(one) == 2 and {other, other + " more"} & set(kept) and len({other, other + " more"} & set(kept)) == 1
    assert sorted(str(i) for i, _ in got).count("9") == 2 and (8, "alone and short") in got and len(got) == 6


def test_mixing_and_packing_stages(steps):
    total = sum(len(WORD.findall(t or "")) for _, t in pairs(steps["near_dup"]))
    mixed = [len(WORD.findall(t)) for _, t in pairs(steps["mixing"])]
    assert abs(sum(mixed) - total) <= 3 and min(mixed) > 0
    packed = steps["packing"]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
    per_doc = packed.groupBy("doc_id").agg(F.sum("length").alias("n")).count()
    assert per_doc == steps["mixing"].select("doc_id").distinct().count()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, f in P.STAGES:
        docs = f(spark, docs, "unused")
        assert docs.count() == 0


def test_every_operator_has_one_query():
    names = list(registry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(registry.oracle_sql()) <= set(names)


def test_queries_match_their_sql(spark):
    names = sorted(registry.oracle_sql())
    results = compare(spark, SF_SMALL, names, verbose=False)
    assert all(results[n]["ok"] for n in names), results
