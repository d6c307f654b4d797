"""The stored tables: no step of a write that dies may lose or invent history."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerwise import constants as C
from ledgerwise.operators import reports, scd2
from ledgerwise.plans.batch import apply_scd2
from ledgerwise.sources import tables
from tests.test_scd2 import FEED, ONE, STAMPS, stored

OTHER = ("y", *ONE[1:4], date(2020, 1, 2), *ONE[5:])
CHANGED = (*ONE[:2], 6.0, *ONE[3:])


class Died(Exception):
    pass


def die(*_, **__):
    raise Died


def incomplete(spark, path, name, text):
    """A publish that dies while the pointer is written."""
    fs, p = tables._fs(spark, f"{path}/.half")
    stream = fs.create(p, False)
    stream.write(bytearray(text[: len(text) // 2].encode()))
    stream.close()
    raise Died


STEPS = {
    "before the pointer": (tables.Table, "_publish", die),
    "inside the pointer": (tables, "_create", incomplete),
    "after the pointer": (tables.Table, "_clean", die),
}


@pytest.mark.parametrize("rewrite", ["affected", "full"])
@pytest.mark.parametrize("step", STEPS)
def test_history_survives_a_death_at_any_step(spark, tmp_path, monkeypatch, step, rewrite):
    calm, path = str(tmp_path / "calm"), str(tmp_path / "curated")
    first, second = spark.createDataFrame([ONE, OTHER], FEED), spark.createDataFrame([CHANGED, OTHER], FEED)
    for p in (calm, path):
        apply_scd2(spark, first, STAMPS[0], p, rewrite=rewrite)
    before = stored(spark, path)
    apply_scd2(spark, second, STAMPS[1], calm, rewrite=rewrite)
    owner, name, replacement = STEPS[step]
    with monkeypatch.context() as m:
        m.setattr(owner, name, replacement)
        with pytest.raises(Died):
            apply_scd2(spark, second, STAMPS[1], path, rewrite=rewrite)
    assert stored(spark, path) == (stored(spark, calm) if step == "after the pointer" else before)
    apply_scd2(spark, second, STAMPS[1], path, rewrite=rewrite)
    assert stored(spark, path) == stored(spark, calm)
    assert len(tables._entries(spark, f"{path}/{tables.DATA}")) <= 3


@pytest.mark.parametrize("step", STEPS)
def test_first_load_can_be_repeated(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "curated")
    feed = spark.createDataFrame([ONE, OTHER], FEED)
    owner, name, replacement = STEPS[step]
    with monkeypatch.context() as m:
        m.setattr(owner, name, replacement)
        with pytest.raises(Died):
            apply_scd2(spark, feed, STAMPS[0], path)
    assert tables.curated_table(spark, path).version == (step == "after the pointer")
    apply_scd2(spark, feed, STAMPS[0], path)
    assert len(stored(spark, path)) == 2


def test_no_marker_file_is_needed(spark, tmp_path):
    path = str(tmp_path / "curated")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        apply_scd2(spark, spark.createDataFrame([ONE, OTHER], FEED), STAMPS[0], path)
        got = apply_scd2(spark, spark.createDataFrame([CHANGED], FEED), STAMPS[1], path)
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert got["closed"] == 1 and len(stored(spark, path)) == 3


@pytest.mark.parametrize("rewrite", ["affected", "full"])
def test_a_plain_parquet_table_is_adopted(spark, tmp_path, rewrite):
    path = str(tmp_path / "curated")
    row = (*ONE, STAMPS[0], datetime(2199, 12, 31), True)
    spark.createDataFrame([row], scd2.CURATED_SCHEMA).write.partitionBy("transaction_date").parquet(path)
    (tmp_path / "curated" / "_SUCCESS").unlink()
    assert apply_scd2(spark, spark.createDataFrame([CHANGED], FEED), STAMPS[1], path, rewrite=rewrite)["closed"] == 1
    assert len(stored(spark, path)) == 2


def test_doubtful_states_raise(spark, tmp_path):
    (tmp_path / "notes").mkdir()
    (tmp_path / "notes" / "readme.txt").write_text("not a table")
    with pytest.raises(ValueError):
        tables.read_curated(spark, str(tmp_path / "notes"))
    path = str(tmp_path / "curated")
    apply_scd2(spark, spark.createDataFrame([ONE], FEED), STAMPS[0], path)
    for name in tables._entries(spark, f"{path}/{tables.DATA}"):
        (tmp_path / "curated" / tables.DATA / name).rename(tmp_path / "elsewhere")
    with pytest.raises(ValueError):
        tables.read_curated(spark, path)


def test_an_empty_table_is_a_typed_frame(spark, tmp_path):
    absent = tables.read_curated(spark, str(tmp_path / "absent"))
    assert absent.schema == scd2.CURATED_SCHEMA and absent.collect() == []
    nothing = spark.createDataFrame([], "transaction_id string, raw_payload string, source_file string, stage string, dq_flag string")
    path = str(tmp_path / "clean run")
    row = spark.createDataFrame([(None, "{", None, "INGEST_LEDGER", "CORRUPT_JSON")], nothing.schema)
    for rows in (row, nothing):  # the second run has nothing to quarantine
        tables.write_quarantine(rows, path, "s", STAMPS[0])
    back = tables.read_quarantine(spark, path)
    assert back.columns == tables.QUARANTINE_SCHEMA.fieldNames() and back.collect() == []
    assert tables.quarantine_table(spark, path).version == 2
    merged = scd2.scd2_merge(absent, spark.createDataFrame([ONE], FEED), STAMPS[0])
    assert [r["is_current"] for r in merged.collect()] == [True]


@pytest.mark.parametrize("rewrite", ["affected", "full"])
def test_a_lost_update_raises(spark, tmp_path, monkeypatch, rewrite):
    """A writer that read version 1 publishes after version 2."""
    path = str(tmp_path / "curated")
    apply_scd2(spark, spark.createDataFrame([ONE, OTHER], FEED), STAMPS[0], path, rewrite=rewrite)
    read = tables.curated_table

    def overtaken(*args):
        table = read(*args)
        monkeypatch.setattr(tables, "curated_table", read)
        apply_scd2(spark, spark.createDataFrame([(*OTHER[:2], 9.0, *OTHER[3:])], FEED), STAMPS[1], path, rewrite=rewrite)
        return table

    monkeypatch.setattr(tables, "curated_table", overtaken)
    late = spark.createDataFrame([CHANGED], FEED)
    with pytest.raises(tables.ConcurrentWrite):
        apply_scd2(spark, late, STAMPS[2], path, rewrite=rewrite)
    assert {(r["transaction_id"], r["amount"]) for r in tables.read_curated(spark, path).filter("is_current").collect()} == {("z", 5.0), ("y", 9.0)}
    assert apply_scd2(spark, late, STAMPS[2], path, rewrite=rewrite)["closed"] == 1  # run again on what is there now
    assert len(stored(spark, path)) == 4


def test_a_slow_writers_files_outlive_another_publish(spark, tmp_path, monkeypatch):
    """Another run publishes and cleans up between a writer's files and its
    pointer: the files stay, the publish fails, the table is the other's."""
    path = str(tmp_path / "curated")
    slow, publish = tables.curated_table(spark, path), tables.Table._publish
    found = []

    def other_first(table, folders):
        monkeypatch.setattr(tables.Table, "_publish", publish)
        apply_scd2(spark, spark.createDataFrame([OTHER], FEED), STAMPS[0], path)
        found.extend(n for n in folders.values() if n in tables._entries(spark, f"{path}/{tables.DATA}"))
        publish(table, folders)

    monkeypatch.setattr(tables.Table, "_publish", other_first)
    with pytest.raises(tables.ConcurrentWrite):
        slow.replace(spark.createDataFrame([(*ONE, STAMPS[0], STAMPS[1], True)], scd2.CURATED_SCHEMA))
    assert len(found) == 1
    assert [r["transaction_id"] for r in tables.read_curated(spark, path).collect()] == ["y"]


def test_files_that_went_before_the_publish_are_missed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "curated")
    apply_scd2(spark, spark.createDataFrame([ONE], FEED), STAMPS[0], path)
    before, entries = stored(spark, path), tables._entries
    monkeypatch.setattr(tables, "_entries", lambda spark, p: {} if "/snap=" in p else entries(spark, p))
    with pytest.raises(ValueError, match="lacks"):
        apply_scd2(spark, spark.createDataFrame([CHANGED], FEED), STAMPS[1], path)
    monkeypatch.undo()
    assert stored(spark, path) == before


def test_two_publishes_of_one_version_at_one_time(spark, tmp_path):
    path = f"{tmp_path}/pointers"
    assert tables._create(spark, path, "0000000001", "first\n")
    assert not tables._create(spark, path, "0000000001", "second\n")
    assert tables._read_small(spark, f"{path}/0000000001") == "first\n"


def test_old_files_go_once_nobody_can_need_them(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "curated")
    feeds = [spark.createDataFrame([(*ONE[:2], float(k), *ONE[3:])], FEED) for k in range(4)]
    for feed, now in zip(feeds[:3], STAMPS):
        apply_scd2(spark, feed, now, path)
    assert len(tables._entries(spark, f"{path}/{tables.DATA}")) == 3
    monkeypatch.setattr(tables, "GRACE_SECONDS", -5)
    apply_scd2(spark, feeds[3], STAMPS[3], path)
    assert len(tables._entries(spark, f"{path}/{tables.DATA}")) == 2  # this version and the one before
    assert sorted(int(n) for n in tables._entries(spark, f"{path}/{tables.PUBLISHED}")) == [3, 4]
    assert len(stored(spark, path)) == 4


def test_only_affected_partitions_are_written(spark, tmp_path):
    path = str(tmp_path / "curated")
    apply_scd2(spark, spark.createDataFrame([ONE, OTHER], FEED), STAMPS[0], path)
    before = tables.curated_table(spark, path).folders
    apply_scd2(spark, spark.createDataFrame([CHANGED, OTHER], FEED), STAMPS[1], path)
    after = tables.curated_table(spark, path).folders
    assert {f for f in after if after[f] != before.get(f)} == {"transaction_date=2020-01-01"}


def scanned(df):
    """Rows that the scans of an executed plan gave out, and files they read."""
    df.collect()
    rows, files = [], []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec":
            metrics = node.metrics()
            rows.append(metrics.apply("numOutputRows").value())
            files.append(metrics.apply("numFiles").value())
        children = node.children()
        for k in range(children.size()):
            walk(children.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(rows), sum(files)


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    """One id among three dates of many ids: the files sorted by id and their
    Bloom filters leave one row group; without them every date is read."""
    dates = [date(2020, 1, d) for d in (1, 2, 3)]
    ids = spark.range(60_000).select(
        F.format_string("t%08d", F.pmod(F.xxhash64("id"), F.lit(100_000_000))).alias("transaction_id"), F.lit("a").alias("account_id"),
        F.col("id").cast("double").alias("amount"), F.lit("EUR").alias("currency"), F.element_at(F.array(*map(F.lit, dates)), (F.col("id") % 3 + 1).cast("int")).alias("transaction_date"),
        F.lit("S").alias("status"), F.lit("MATCHED").alias("recon_status"),
    )
    rows = scd2.open_versions(ids, STAMPS[0])
    tables.curated_table(spark, f"{tmp_path}/indexed", 20_000).replace(rows)
    rows.select(*scd2.CURATED_SCHEMA.fieldNames()).repartition(1).write.partitionBy("transaction_date").parquet(f"{tmp_path}/plain")
    some = ids.filter("amount = 17").first()["transaction_id"]
    read = {n: scanned(reports.scd2_history(tables.read_curated(spark, f"{tmp_path}/{n}"), some))[0] for n in ("indexed", "plain")}
    assert read["indexed"] <= 20_000 < read["plain"] == 60_000


def test_browsing_opens_only_the_chosen_folders(spark, tmp_path):
    path = str(tmp_path / "curated")
    days = [(f"t{d}", *ONE[1:4], date(2020, 1, d), *ONE[5:]) for d in range(1, 20)] + [("t0", *ONE[1:4], None, *ONE[5:])]
    apply_scd2(spark, spark.createDataFrame(days, FEED), STAMPS[0], path)
    some = reports.browse_stored_curated(spark, path, ["2020-01-03", "2020-01-05", "1999-01-01"])
    assert sorted(r["transaction_id"] for r in some.collect()) == ["t3", "t5"]
    assert {f.split("/")[-2] for f in some.inputFiles()} == {"transaction_date=2020-01-03", "transaction_date=2020-01-05"}
    assert reports.browse_stored_curated(spark, path, ["1999-01-01"]).collect() == []
    assert [r["transaction_id"] for r in tables.read_curated(spark, path, [None]).collect()] == ["t0"]
    assert reports.browse_stored_curated(spark, path, None, [C.RECON_MATCHED]).count() == 20
