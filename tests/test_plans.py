"""Plan properties the design relies on (checked with broadcast off, as at scale)."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerwise import constants as C
from ledgerwise.operators import reports, scd2
from ledgerwise.plans.scenario import Scenario
from ledgerwise.sources import tables
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    # A fresh projection is planned now, with the current session settings
    # (a DataFrame's own query execution is planned once and kept).
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", plan))


def test_reconcile_join_reuses_key_partitioning(spark, no_broadcast):
    plan = _plan(E.queries()["recon_rows"](spark, SF_SMALL))
    assert "SortMergeJoin" in plan
    # Only the keep-latest of the feed and the ledger side shuffle.
    assert _exchanges(plan) == 2
    join_at = plan.index("SortMergeJoin")
    assert not re.match(r"\s*[:+| -]*Exchange", plan[join_at:].splitlines()[1])


def test_two_run_history_shuffles_little(spark, no_broadcast):
    plan = _plan(E.queries()["scd2_merge"](spark, SF_SMALL))
    assert _exchanges(plan) <= 4


def test_keep_latest_ships_one_row_per_key_and_task(spark):
    plan = _plan(Scenario(spark, SF_SMALL).dedup.kept)
    assert "WindowGroupLimit" in plan and "Partial" in plan  # before the shuffle


def test_only_repeated_ids_are_ranked_as_losers(spark, no_broadcast):
    plan = _plan(Scenario(spark, SF_SMALL).dedup.all_rows())
    assert len(re.findall("FileScan parquet", plan)) <= 4  # winners, counts, rows of repeated ids, rejected rows
    assert plan.count("SortMergeJoin") == 1


def test_scan_prunes_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(E.queries()["dq_null_id"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("o_orderpriority" not in s for s in schemas)


def test_curated_browse_prunes_and_pushes(spark, tmp_path):
    s = Scenario(spark, SF_SMALL)
    path = str(tmp_path / "curated")
    tables.write_curated(s.curated_initial, path)
    view = reports.curated_browse(tables.read_curated(spark, path), ["1998-01-01"], [C.RECON_MATCHED])
    plan = _plan(view)
    assert re.search(r"PartitionFilters: \[[^\]]*transaction_date", plan)
    assert re.search(r"PushedFilters: \[[^\]]*recon_status", plan)
    assert view.count() == s.curated_initial.filter(
        (F.col("transaction_date") == F.lit("1998-01-01").cast("date")) & (F.col("recon_status") == "MATCHED")
    ).count()


def test_hot_key_join_is_split(spark, no_broadcast):
    from ledgerwise.operators.latest import keep_latest

    confs = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        wide = F.repeat(F.sha2(F.col("id").cast("string"), 256), 4)
        hot = spark.range(0, 20000).select(F.lit("HOT").alias("k"), F.col("id").alias("v"), wide.alias("w"))
        cold = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), wide.alias("w"))
        split = keep_latest(hot.unionByName(cold), "k", ["v"])
        losers = split.losers.select("*")
        assert len(losers.collect()) == 22000 - 2001
        final = losers._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final
        assert "isSkewJoin=true" in final or "skew=true" in final, final
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
