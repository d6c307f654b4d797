"""Work that is bounded by the feed: the id filter, the merge, and routing."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import id_filter, reports, routing, scd2
from ledgerwise.operators.latest import keep_latest
from ledgerwise.plans.batch import apply_scd2, stage_incoming
from ledgerwise.plans.scenario import Scenario
from ledgerwise.sources import ndjson, tables
from tests.conftest import SF_SMALL
from tests.test_plans import _plan, no_broadcast  # noqa: F401
from tests.test_scd2 import FEED, ONE, STAMPS, by_sql, generated_runs


@pytest.mark.parametrize("rows, bits", [(0, 1 << 15), (1, 1 << 15), (3000, 1 << 16), (10**6, 1 << 24), (10**9, 1 << 28)])
def test_filter_size_is_bounded(rows, bits):
    assert id_filter.filter_bits(rows) == bits


def test_filter_keeps_every_id_and_few_others(spark):
    ids = spark.range(0, 3000).select(F.concat(F.lit("é"), "id").alias("k")).unionByName(spark.createDataFrame([(None,), ("",)], "k string"))
    bits = id_filter.filter_bits(3000)
    made = id_filter.id_filter(ids, "k", bits)
    big = spark.range(0, 100_000).select(F.concat(F.lit("é"), "id").alias("k"), "id").unionByName(spark.createDataFrame([(None, -1), ("", -2)], "k string, id long"))
    got = id_filter.maybe_in(big, "k", made, bits)
    assert got.columns == ["k", "id"]
    found = {r["id"] for r in got.collect()}
    assert set(range(3000)) | {-2} <= found and -1 not in found
    assert len(found) < 3000 + 2 * 97_000 / id_filter.FALSE_ONE_IN
    assert id_filter.maybe_in(big, "k", id_filter.id_filter(ids.limit(0), "k", bits), bits).count() == 0


def table_of(spark, n):
    ids = spark.range(n).select(F.format_string("t%07d", "id").alias("transaction_id"), F.lit("a").alias("account_id"), F.col("id").cast("double").alias("amount"),
                                F.lit("EUR").alias("currency"), F.lit(date(2020, 1, 1)).alias("transaction_date"), F.lit("S").alias("status"), F.lit("MATCHED").alias("recon_status"))
    return tables.staged(scd2.open_versions(ids, STAMPS[0]), "table"), ids


def shuffled(df):
    """Records written by the exchanges of an executed plan."""
    df.collect()
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(out)


def test_the_merge_shuffles_with_the_feed_and_not_with_the_table(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        moved = []
        for n in (20_000, 80_000):
            stored, ids = table_of(spark, n)
            feed, seen = stage_incoming(ids.filter("amount % 500 = 7 and amount < 20000").withColumn("status", F.lit("P")))
            classified = scd2.classify_feed(stored, feed, seen["incoming"])
            plan = _plan(classified)
            join = plan[plan.index("SortMergeJoin") :]
            right = join[join.index("+- "):]  # the stored side: the filter's join stands below the exchange
            assert re.search(r"Exchange hashpartitioning\(c_transaction_id.*BroadcastHashJoin.*FileScan", right, re.S)
            moved.append(shuffled(classified))
            assert {r["change"]: r["count"] for r in classified.groupBy("change").count().collect()} == {scd2.CHANGE_CHANGED: 40}
        assert moved[1] < moved[0] + 80_000 / id_filter.FALSE_ONE_IN < 0.2 * 80_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_feed_classification_equals_the_full_one(spark):
    first, second = generated_runs(seed=5, runs=2)
    table = tables.staged(scd2.scd2_initial(spark.createDataFrame(first, FEED), STAMPS[0]), "first")
    odd = spark.createDataFrame([(None, *ONE[1:], STAMPS[0], datetime(2199, 12, 31), True), (*ONE, STAMPS[0], STAMPS[1], False)], scd2.CURATED_SCHEMA)
    table = table.unionByName(odd)
    feed, seen = stage_incoming(spark.createDataFrame(second, FEED))
    full = scd2.classify(table, feed)
    bounded = scd2.classify_feed(table, feed, seen["incoming"])
    assert sorted(map(str, bounded.collect())) == sorted(map(str, full.filter(F.col("change") != scd2.CHANGE_ABSENT).collect()))
    counts = scd2.scd2_counts(full).first().asDict()
    assert scd2.absent_count(table, counts) == counts["absent"]
    assert bounded.agg(*scd2.class_counts()).first().asDict().items() <= counts.items()


def test_first_load_takes_the_same_path(spark, tmp_path):
    runs = generated_runs(seed=9, runs=1)
    assert apply_scd2(spark, spark.createDataFrame([], FEED), STAMPS[0], f"{tmp_path}/t") == {"inserted": 0, "closed": 0, "unchanged": 0, "new_ids": 0}
    assert tables.read_curated(spark, f"{tmp_path}/t").collect() == []
    expected, counts = by_sql(runs)
    assert apply_scd2(spark, spark.createDataFrame(runs[0], FEED), STAMPS[0], f"{tmp_path}/t") == counts[0]
    assert sorted(repr(tuple(r)) for r in tables.read_curated(spark, f"{tmp_path}/t").collect()) == expected


def test_counted_is_the_winners_and_their_rows(spark):
    rows = [("a", 1, "x"), ("a", 2, None), ("a", 2, "y"), ("b", None, "z"), ("b", None, "z"), ("c", 5, "w"), (None, 9, "n")]
    df = spark.createDataFrame(rows, "k string, v int, w string").repartition(3)
    split = keep_latest(df, "k", ["v"])
    counted = split.counted
    assert sorted(map(tuple, counted.collect())) == [("a", 2, "y", 3), ("b", None, "z", 2), ("c", 5, "w", 1)]
    assert sorted(map(tuple, counted.drop("_rows").collect())) == sorted(map(tuple, split.winners.collect()))
    known = split.losers_among(counted.filter("_rows > 1").select("k"))
    assert sorted(map(str, known.collect())) == sorted(map(str, split.losers.collect()))


def test_rows_of_single_ids_are_not_shuffled_to_the_losers(spark, no_broadcast):  # noqa: F811
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        ids = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"))
        df = tables.staged(ids.unionByName(ids.filter("k like '%777'").withColumn("v", F.lit(2))), "repeated")
        split = keep_latest(df, "k", ["v"], null_keys=False, stored=True)
        repeated = tables.staged(split.counted.filter("_rows > 1").select("k"), "known")
        losers = split.losers_among(repeated)
        assert shuffled(losers) < 2000
        assert sorted(map(tuple, losers.collect())) == sorted((f"k{i}", 1) for i in range(20_000) if str(i).endswith("777"))
        assert sorted(map(tuple, split.losers.collect())) == sorted(map(tuple, losers.collect()))
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_text_lines_are_compressed_and_in_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "LINES_PER_FILE", 40)
    lines = [f'{{"transaction_id":"{i}"}} é' for i in range(200)]
    tables.write_text_lines(spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1), f"{tmp_path}/lines")
    assert len(list((tmp_path / "lines").glob("*.gz"))) == 5
    assert sorted(r["value"] for r in ndjson.read_lines(spark, f"{tmp_path}/lines").collect()) == sorted(lines)


def test_counted_hands_its_partitioning_on(spark, no_broadcast):  # noqa: F811
    s = Scenario(spark, SF_SMALL)
    split = routing.latest_transactions(s.routed_feed)
    plan = _plan(split.counted.join(s.ledger.select(F.col("transaction_id").alias("l")), F.col("transaction_id") == F.col("l"), "left"))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2  # one for each side


def test_routing_flags_every_row_once(spark):
    lines = ['{"transaction_id":"a","amount":1.0,"transaction_date":"2001-01-01","updated_at":"2001-01-01T00:00:00"}', "{bad", "null", " ",
             '{"transaction_id":null,"amount":-1}', '{"transaction_id":"b","amount":0}', '{"transaction_id":"c","amount":1,"transaction_date":"soon"}', '{"amount":"x"}']
    df = spark.createDataFrame([(v, f"file{i}") for i, v in enumerate(lines)], "value string, source_file string")
    routed = routing.route_transactions(ndjson.parse_json_lines(df, C.TRANSACTION_SCHEMA), "2001-07-01")
    assert routed.rejected.columns == C.QUARANTINE_COLUMNS
    assert [(r["transaction_id"], r["source_file"]) for r in routed.ok.collect()] == [("a", "file0")]
    got = {r["source_file"]: (r["transaction_id"], r["stage"], r["dq_flag"]) for r in routed.rejected.collect()}
    corrupt = (None, C.STAGE_INGEST_TRANSACTIONS, C.FLAG_CORRUPT_JSON)
    assert got == {"file1": corrupt, "file2": corrupt, "file7": corrupt, "file4": (None, C.STAGE_TRANSFORM, C.FLAG_NULL_ID),
                   "file5": ("b", C.STAGE_TRANSFORM, C.FLAG_NEGATIVE_AMOUNT), "file6": ("c", C.STAGE_TRANSFORM, C.FLAG_INVALID_DATE)}
    payload = {r["source_file"]: r["raw_payload"] for r in routed.rejected.collect()}
    assert payload["file1"] == "{bad" and '"transaction_date":"soon"' in payload["file6"]


def test_routed_ledger(spark):
    rows = [("a", 1.0), ("a", 2.0), (None, 3.0)]
    df = spark.createDataFrame([(i, a, "S", "Y", None) for i, a in rows], "transaction_id string, ledger_amount double, ledger_status string, cleared_flag string, cleared_date string")
    routed = routing.route_ledger(df)
    assert [(r["dq_flag"], r["stage"]) for r in routed.rejected.collect()] == [(C.FLAG_NULL_ID, C.STAGE_RECONCILE_LEDGER)]
    split = routing.latest_ledger(routed)
    assert [r["ledger_amount"] for r in split.winners.collect()] == [2.0] and [r["ledger_amount"] for r in split.losers.collect()] == [1.0]


def test_the_quarantine_scans_each_input_once(spark):
    """Events once, orders once for the ledger lines; feed and ledger come from
    their routed rows, of which the rejected ones are read once."""
    s = Scenario(spark, SF_SMALL)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = _plan(s.quarantine_all)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = re.findall(r"FileScan parquet.*?Location: \S+\s?\S*?\[(\S+?)\].*?PartitionFilters: \[(.*?)\], PushedFilters", plan)
    inputs = [re.search(r"/(\w+)\.parquet", path)[1] for path, _ in scans if SF_SMALL in path]
    assert sorted(inputs) == ["events", "orders"]
    routed = [re.search(r"routed-(\w+)", path)[1] for path, parts in scans if "routed-" in path and "rejected" in parts]
    assert sorted(routed) == ["ledger", "transactions"]


def test_the_test_for_breaks_is_a_subquery_of_one_row(spark):
    df = tables.staged(Scenario(spark, SF_SMALL).reconciled, "reconciled")
    plan = _plan(reports.recon_breaks(df))
    assert "Subquery" in plan and "Limit 1" in plan and "HashAggregate" not in plan
