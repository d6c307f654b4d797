from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import quarantine
from ledgerwise.plans.scenario import Scenario
from ledgerwise.sources import tables
from tests.conftest import SF_SMALL


def test_union_shape_and_payload(spark):
    s = Scenario(spark, SF_SMALL)
    q = s.quarantine_all
    assert q.columns == C.QUARANTINE_COLUMNS
    bad_date = q.filter(F.col("dq_flag") == C.FLAG_INVALID_DATE).select(
        F.get_json_object("raw_payload", "$.transaction_date").alias("d")
    )
    assert bad_date.filter(F.col("d") == "not-a-date").count() > 0
    stages = {r["stage"] for r in q.select("stage").distinct().collect()}
    assert stages == {C.STAGE_INGEST_TRANSACTIONS, C.STAGE_INGEST_LEDGER, C.STAGE_TRANSFORM, C.STAGE_RECONCILE_LEDGER}


def test_rewrite_drops_stale_flags(spark, tmp_path):
    s = Scenario(spark, SF_SMALL)
    path = str(tmp_path / "q")
    tables.write_quarantine(s.quarantine_all, path, "initial", "2001-07-01 09:00:00")
    only_dups = s.quarantine_all.filter(F.col("dq_flag") == C.FLAG_DUPLICATE)
    tables.write_quarantine(only_dups, path, "updated", "2001-07-01 15:00:00")
    back = tables.read_quarantine(spark, path)
    assert {r["dq_flag"] for r in back.select("dq_flag").distinct().collect()} == {C.FLAG_DUPLICATE}
    assert back.count() == only_dups.count()


def test_browse_prunes_partitions(spark, tmp_path):
    s = Scenario(spark, SF_SMALL)
    path = str(tmp_path / "q")
    tables.write_quarantine(s.quarantine_all, path, "initial", "2001-07-01 09:00:00")
    view = quarantine.browse_quarantine(tables.read_quarantine(spark, path), [C.FLAG_NULL_ID])
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dq_flag" in plan and "NULL_ID" in plan
    assert view.count() == s.quarantine_all.filter(F.col("dq_flag") == C.FLAG_NULL_ID).count()
