"""End to end: NDJSON files -> run_batch twice -> golden counts (sf0.001)."""

from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.plans.batch import run_batch
from ledgerwise.plans.scenario import Scenario
from ledgerwise.sources import feeds, tables
from tests.conftest import SF_SMALL


def _json_lines(df):
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def test_two_batches(spark, tmp_path):
    s = Scenario(spark, SF_SMALL)
    corrupt_lines = s.event_split[1].select(F.col("raw_payload").alias("value"))
    txn1, txn2, ledger = str(tmp_path / "txn1"), str(tmp_path / "txn2"), str(tmp_path / "ledger")
    tables.write_text_lines(_json_lines(s.feed).unionByName(corrupt_lines), txn1)
    tables.write_text_lines(_json_lines(s.updated_feed), txn2)
    tables.write_text_lines(_json_lines(s.ledger), ledger)
    curated, quarantine = str(tmp_path / "curated"), str(tmp_path / "quarantine")

    r1 = run_batch(spark, txn1, ledger, curated, quarantine, "2001-07-01T09:00:00", "initial")
    c = r1.counts
    assert c["dq_passed"] == 1317
    assert (c["flag_NULL_ID"], c["flag_NEGATIVE_AMOUNT"], c["flag_INVALID_DATE"], c["flag_DUPLICATE"]) == (39, 72, 79, 34)
    assert c["flag_CORRUPT_JSON"] == 35
    assert c["ingested_total"] == 1541 + 35
    assert (c["MATCHED"], c["AMOUNT_MISMATCH"], c["STATUS_MISMATCH"], c["UNRECONCILED"]) == (998, 126, 80, 113)
    assert (c["inserted"], c["new_ids"], c["closed"]) == (1317, 1317, 0)
    assert c["reconciled_total"] == 998 + 126 + 80

    r2 = run_batch(spark, txn2, ledger, curated, quarantine, "2001-07-01T15:00:00", "updated")
    c = r2.counts
    assert (c["MATCHED"], c["AMOUNT_MISMATCH"], c["STATUS_MISMATCH"], c["UNRECONCILED"]) == (876, 179, 107, 108)
    assert (c["inserted"], c["closed"], c["unchanged"], c["new_ids"], c["absent"]) == (121, 120, 1149, 1, 48)
    back = tables.read_curated(spark, curated)
    assert back.count() == 1438
    assert back.exceptAll(s.curated_merged).count() == 0
    q = tables.read_quarantine(spark, quarantine)
    assert q.filter(F.col("run_scenario") != "updated").count() == 0
    assert q.filter(F.col("dq_flag") == C.FLAG_CORRUPT_JSON).count() == 0  # stale flag partition gone
    summary = {(r["section"], r["metric"]): r["value"] for r in r2.summary(spark).collect()}
    assert summary[("totals", "dq_passed")] == 1270
    assert summary[("quarantined_by_flag", "CORRUPT_JSON")] == 0
