"""The permutation is one, and places depend on rows and key alone."""

import pytest
from pyspark.sql import functions as F

from ledgerwise.llm import sharding as S


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1009])
def test_permutation_and_inverse(spark, n):
    df = spark.range(n).select("id", S.permute(F.col("id"), n, 5).alias("p"))
    df = df.select("id", "p", S.unpermute(F.col("p"), n, 5).alias("back"), S.permute(F.col("id"), F.lit(n).cast("long"), F.lit("5")).alias("by_column"))
    rows = df.collect()
    assert sorted(r["p"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] and r["by_column"] == r["p"] for r in rows)


def test_places(spark):
    rows = [(i % 50, f"t{i}") for i in range(300)] + [(None, None)] * 3 + [(7, "same")] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("slot", F.lit("clash"))
    outs = []
    for parts in (1, 7):
        out = S.shard_rows(df.repartition(parts), ["doc_id"], shards=8).select("doc_id", "text", "shard", "slot").collect()
        assert len(out) == len(rows)
        for shard in range(8):
            slots = sorted(r["slot"] for r in out if r["shard"] == shard)
            assert slots == list(range(len(slots))) and len(slots) in (len(rows) // 8, len(rows) // 8 + 1)
        outs.append(sorted(map(str, out)))
    assert outs[0] == outs[1]
    other = S.shard_rows(df, ["doc_id"], shards=8, seed=9).select("doc_id", "text", "shard", "slot").collect()
    assert sorted(map(str, other)) != outs[0]
    assert S.shard_rows(df.limit(0), ["doc_id"]).count() == 0


def test_a_row_that_is_a_third_of_the_table(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"))
    whole = sorted(map(tuple, S.number_rows(df, ["doc_id"]).collect()))
    out = sorted(map(tuple, S.number_rows(df.repartition(3), ["doc_id"], chunk=10).collect()))
    assert out == whole and sorted(n for _, n in out) == list(range(2000))
    held = S.number_rows(df, ["doc_id"], chunk=10).filter("doc_id = 5").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in held) < 667  # the run is spread


def test_null_and_very_long_texts_through_the_query(spark, tmp_path):
    import zlib

    texts = [None, "", "é" * 1_500_000, "same", "same"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "x")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: r for r in S.op2_sharding(spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        assert (out[i]["size"], out[i]["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    assert len(out) == 6


def test_no_python_on_the_way(spark):
    from tests.conftest import SF_SMALL

    plan = S.op2_sharding(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "ArrowEval" not in plan
