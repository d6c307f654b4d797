from datetime import date

from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import reconcile, reports, summary
from ledgerwise.plans.scenario import Scenario
from ledgerwise.sources import tables
from tests.conftest import SF_SMALL


def test_breaks_default(spark):
    df = spark.createDataFrame([("a", "MATCHED"), ("b", "UNRECONCILED")], "transaction_id string, recon_status string")
    assert [r["transaction_id"] for r in reports.recon_breaks(df).collect()] == ["b"]
    only_matched = df.filter("recon_status = 'MATCHED'")
    assert reports.recon_breaks(only_matched).count() == 1
    assert reports.recon_breaks(df, ["MATCHED"]).count() == 1


def test_changed_fields_counts_null_as_value(spark):
    rows = [
        ("A", 1.0, "S", None, 1),
        ("A", 1.0, "S", "MATCHED", 2),
        ("B", 1.0, "S", "MATCHED", 1),
        ("B", 2.0, "F", "MATCHED", 2),
    ]
    df = spark.createDataFrame(rows, "transaction_id string, amount double, status string, recon_status string, v int")
    got = {r["transaction_id"]: r["changed_fields"] for r in reports.changed_fields(df).collect()}
    assert got == {"A": "recon_status", "B": "amount,status"}


def test_browse_and_pick_lists(spark):
    s = Scenario(spark, SF_SMALL)
    cur = s.curated_merged
    some_day = cur.select("transaction_date").first()[0]
    picked = reports.curated_browse(cur, [some_day.isoformat()], None, current_only=False)
    assert picked.count() == cur.filter(F.col("transaction_date") == some_day).count()
    values = reports.distinct_values(cur, ["recon_status", "transaction_id"]).collect()
    assert sorted(r["value"] for r in values if r["field"] == "recon_status") == sorted(C.RECON_STATUSES)
    ids = [r["value"] for r in reports.pick_list(cur, "transaction_id").collect()]
    assert ids == sorted(r["value"] for r in values if r["field"] == "transaction_id")


def test_summary_equals_the_rows_it_counts(spark):
    s = Scenario(spark, SF_SMALL)
    full = summary.run_summary(
        s.dq_counts, s.reconciled_repeated, s.event_lines_parsed, s.ledger_lines_parsed,
        reconcile.surplus_counts(s.repeated_ledger),
    )
    got = {(r["section"], r["metric"]): r["value"] for r in full.collect()}
    rows = s.quarantine_all.groupBy("stage", "dq_flag").count().collect()
    for flag in C.QUARANTINE_FLAGS:
        assert got[("quarantined_by_flag", flag)] == sum(r["count"] for r in rows if r["dq_flag"] == flag)
    for stage in summary.QUARANTINE_STAGES:
        assert got[("quarantined_by_stage", stage)] == sum(r["count"] for r in rows if r["stage"] == stage)
    assert got[("quarantined_by_flag", C.FLAG_CORRUPT_JSON)] > 0
    assert got[("totals", "quarantined_total")] == sum(r["count"] for r in rows)
    assert got[("totals", "ingested_total")] == s.feed.count() + s.event_split[1].count()
    head = summary.run_headline(full).first()
    assert head["passed"] == s.clean.count() and head["reconciled"] + head["unreconciled"] == head["passed"]


def test_counts_plan_reads_each_input_once(spark):
    s = Scenario(spark, SF_SMALL)
    plan = s.dq_counts.select("*")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_history_of_one_id_reaches_the_scan(spark, tmp_path):
    s = Scenario(spark, SF_SMALL)
    path = str(tmp_path / "curated")
    tables.write_curated(s.curated_merged, path)
    some = s.curated_merged.filter(~F.col("is_current")).first()["transaction_id"]
    one = reports.scd2_history(tables.read_curated(spark, path), some)
    assert [r["version"] for r in one.collect()] == [1, 2]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = one.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert f"EqualTo(transaction_id,{some})" in plan
