"""Data-quality rules and keep-latest, as tables of cases."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import dq
from ledgerwise.operators.latest import expand_copies, keep_latest
from tests.conftest import SF_SMALL

RUN_DAY = "2020-02-15"
# field values of an acceptable transaction
FINE = ("id-1", "acct", 12.5, "CHF", "2020-01-31", "OPEN", "2020-02-01T08:30:00")
ID, AMOUNT, DAY, STAMP = 0, 2, 4, 6

# (changes to FINE, expected flag)
RULES = [
    ({}, C.FLAG_OK),
    ({ID: None}, C.FLAG_NULL_ID),
    ({ID: ""}, C.FLAG_OK),
    ({AMOUNT: 0.0}, C.FLAG_NEGATIVE_AMOUNT),
    ({AMOUNT: -0.01}, C.FLAG_NEGATIVE_AMOUNT),
    ({AMOUNT: None}, C.FLAG_NEGATIVE_AMOUNT),
    ({AMOUNT: float("nan")}, C.FLAG_OK),
    ({DAY: RUN_DAY}, C.FLAG_OK),
    ({DAY: "2020-02-16"}, C.FLAG_INVALID_DATE),
    ({DAY: None}, C.FLAG_INVALID_DATE),
    ({STAMP: None}, C.FLAG_INVALID_DATE),
    ({ID: None, AMOUNT: -4.0, DAY: "?"}, C.FLAG_NULL_ID),
    ({AMOUNT: -4.0, DAY: "?"}, C.FLAG_NEGATIVE_AMOUNT),
]
RULES += [({DAY: d}, C.FLAG_INVALID_DATE) for d in ("", "31.01.2020", "2020-1-31", "2019-02-29", "20200131", " 2020-01-31", "2020-01-31T00:00:00")]
RULES += [({STAMP: t}, C.FLAG_INVALID_DATE) for t in ("", "2020-02-01 08:30:00", "2020-02-01T24:00:00", "2019-02-29T08:30:00", "2020-02-01T08:30:00+01:00")]


def feed(spark, changes):
    rows = [tuple(change.get(i, v) for i, v in enumerate(FINE)) for change in changes]
    return spark.createDataFrame(rows, C.TRANSACTION_SCHEMA)


def test_one_flag_per_row(spark):
    df = feed(spark, [{**c, 1: f"case {i}"} for i, (c, _) in enumerate(RULES)])
    got = {r["account_id"]: r["dq_flag"] for r in dq.apply_dq_rules(df, RUN_DAY).collect()}
    assert got == {f"case {i}": flag for i, (_, flag) in enumerate(RULES)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = dq.apply_dq_rules(feed(spark, [{STAMP: "2020-03-08T02:30:00", DAY: "2020-01-01"}]), RUN_DAY)
        row = df.select(F.col("updated_at").cast("string").alias("t"), F.col("transaction_date").cast("string").alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row["t"], row["d"]) == ("2020-03-08 02:30:00", "2020-01-01")


def expected_split(rows):
    """Winner per id by (updated_at, then the other fields, nulls last), the
    rest losers: by sorting in Python."""

    def rank(r):
        rest = [r[i] for i in (STAMP, 1, AMOUNT, 3, DAY, 5)]
        return [(v is not None, v) if v is not None else (False, 0) for v in rest]

    best, lost = [], []
    for _, group in itertools.groupby(sorted(rows, key=lambda r: r[ID]), key=lambda r: r[ID]):
        *losers, winner = sorted(group, key=rank)
        best.append(winner)
        lost += losers
    return sorted(map(repr, best)), sorted(map(repr, lost))


@pytest.mark.parametrize("parts,shuffle", [(1, "2"), (6, "5")])
def test_keep_latest_equals_sorting(spark, parts, shuffle):
    rnd = random.Random(5)
    rows = []
    for _ in range(400):
        key = rnd.choice(["hot"] * 6 + [f"k{rnd.randrange(60)}"])
        rows.append((key, rnd.choice("ab"), rnd.choice([1.0, 2.0]), "EUR", "2020-01-01", rnd.choice(["X", None]), f"2020-01-0{rnd.randrange(1, 4)}T00:00:00"))
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        result = dq.dedup_latest(dq.apply_dq_rules(spark.createDataFrame(rows, C.TRANSACTION_SCHEMA).repartition(parts), RUN_DAY, keep_raw=False))
        text = [*C.TRANSACTION_COLUMNS[:4], F.date_format("transaction_date", "yyyy-MM-dd"), "status", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss")]
        got = [sorted(repr(tuple(r)) for r in df.select(*text).collect()) for df in (result.kept, result.duplicates)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert tuple(got) == expected_split(rows)


def test_copies_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1)] * 4 + [("a", 0), ("b", 7), (None, 1), (None, 1)], "k string, v int")
    split = keep_latest(df, "k", ["v"])
    assert sorted(map(tuple, split.winners.collect())) == [("a", 1), ("b", 7)]
    assert sorted(map(str, map(tuple, split.losers.collect()))) == sorted(map(str, [("a", 1)] * 3 + [("a", 0), (None, 1), (None, 1)]))
    empty = keep_latest(df.filter("v > 100"), "k", ["v"])
    assert empty.winners.count() == empty.losers.count() == 0


def test_expand_copies_in_chunks(spark):
    counts = spark.createDataFrame([("p", 11), ("q", 1), ("r", 0)], "x string, n long")
    got = sorted(r["x"] for r in expand_copies(counts, "n", chunk=4).collect())
    assert got == ["p"] * 11 + ["q"]


def test_counts_need_no_rows(spark):
    from ledgerwise.plans.scenario import Scenario

    s = Scenario(spark, SF_SMALL)
    by_rows = {r["dq_flag"]: r["count"] for r in s.dedup.all_rows().groupBy("dq_flag").count().collect()}
    assert {r["dq_flag"]: r["n"] for r in s.dq_counts.collect()} == by_rows
    assert sum(by_rows.values()) == s.feed.count()
