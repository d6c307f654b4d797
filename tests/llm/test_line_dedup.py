"""Line dedup against a plain reading of its rule."""

import random

from pyspark.sql import functions as F

from ledgerwise.llm import line_dedup as L

UPPER = {ord(c): c.lower() for c in L.UPPER}


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def by_hand(rows):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= L.MIN_CHARS:
                holders.setdefault(key(line), set()).add(doc)
    order = lambda d: (d is None, d or 0)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)], key=order) == doc]
        out.append((doc, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(map(str, out))


def test_equals_the_rule(spark):
    rnd = random.Random(6)
    pool = [f"line number {i}" for i in range(60)] + ["short", "", "  ", "ÄÖÜ ÄÖÜ ÄÖÜ", "äöü äöü äöü", "nine char", "ten  chars"]
    rows = []
    for doc in range(120):
        lines = [rnd.choice(pool) for _ in range(rnd.randrange(0, 9))]
        lines = [rnd.choice([x, x.upper(), f" \t{x}\r", x]) for x in lines]
        if doc % 3 == 0:
            lines.append("The Common Line Of A Third")
        rows.append((doc, "\n".join(lines)))
    rows += [(None, "line number 1\nonly here in null"), (None, "only here in null"), (500, None), (501, "")]
    rows += [(3, rows[3][1]), (4, "line number 2\nanother text of four")]
    rows.append((600, "\n".join(f"line number {i % 60}" for i in range(5000))))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("words", F.lit(1)).withColumn("n_lines", F.lit("clash"))
    out = L.dedup_lines(df.repartition(6)).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(str(tuple(r)) for r in out) == by_hand(rows)
    assert L.dedup_lines(df.limit(0)).count() == 0


def test_bitmaps_name_only_words_with_a_loss(spark):
    lost = "\n".join(["a line that repeats"] + [f"own line number {i}" for i in range(200)] + ["a line that repeats"])
    df = spark.createDataFrame([(1, "a line that repeats"), (2, lost)], "doc_id long, text string")
    rows = L.keep_bitmaps(df).collect()
    assert [(r["doc_id"], [(w["word"], w["bits"]) for w in r["words"]]) for r in rows] == [(2, [(0, ~1), (3, ~(1 << 9))])]


def test_no_python_on_the_way(spark):
    from tests.conftest import SF_SMALL

    plan = L.op4_line_dedup(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "rangepartitioning(h1" in plan
