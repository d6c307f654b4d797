"""Strict NDJSON ingest: which lines are kept, and which verdict each gets."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.sources import ndjson

# (line, verdict): True parsed, False corrupt, None skipped as blank
LINES = [
    (json.dumps({"transaction_id": "p", "amount": 8}), True),
    (json.dumps({"transaction_id": 12, "amount": 8.25}), True),  # a number in a text field is kept as text
    (json.dumps({"unknown": 1}), True),
    ("{}", True),
    ('{"amount":1,"amount":2}', True),  # of a repeated key the last counts
    (json.dumps({"amount": "8"}), False),
    (json.dumps({"amount": False}), False),
    ("null", False),
    ("[]", False),
    ("17", False),
    ("{", False),
    ('{"amount"', False),
    ("amount=8", False),
    ('{"amount":8} and more', True),  # what follows the first object is not looked at
    ("\u00a0", False),  # not white space to the JSON source
    ("", None),
    ("   ", None),
    ("\t", None),
    (" \t ", None),
]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "day.json").write_text("\n".join(line for line, _ in LINES) + "\n", encoding="utf-8")
    return str(tmp_path / "feed")


def test_every_line_gets_its_verdict(spark, folder):
    parsed = ndjson.read_json_strict(spark, folder, C.TRANSACTION_SCHEMA)
    assert parsed.count() == sum(v is not None for _, v in LINES)
    clean, corrupt = ndjson.split_corrupt(parsed)
    assert clean.count() == sum(v is True for _, v in LINES)
    rows = corrupt.collect()
    assert sorted(r["raw_payload"] for r in rows) == sorted(line for line, v in LINES if v is False)
    assert all(r["source_file"].endswith("/day.json") for r in rows)


def test_values(spark, folder):
    clean, _ = ndjson.load_transactions(spark, folder)
    got = {(r["transaction_id"], r["amount"]) for r in clean.collect()}
    assert {("p", 8.0), ("12", 8.25), (None, 2.0)} <= got


def test_verdict_does_not_depend_on_the_columns_read(spark, folder):
    df = ndjson.read_json_strict(spark, folder, C.TRANSACTION_SCHEMA)
    alone = df.select(F.col(C.CORRUPT_COL).isNotNull().alias("bad")).filter("bad").count()
    ids = df.filter(F.col(C.CORRUPT_COL).isNull()).select("transaction_id").count()
    assert (alone, ids) == (sum(v is False for _, v in LINES), sum(v is True for _, v in LINES))


def test_ledger_schema(spark, tmp_path):
    row = dict(zip(C.LEDGER_COLUMNS, ["q", "N", "2020-05-05", 3.5, None]))
    (tmp_path / "ledger.json").write_text(json.dumps(row) + "\nledger\n")
    clean, corrupt = ndjson.load_ledger(spark, str(tmp_path))
    assert [tuple(r)[:5] for r in clean.select(*C.LEDGER_COLUMNS).collect()] == [tuple(row.values())]
    assert corrupt.count() == 1
