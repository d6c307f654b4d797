"""Line dedup: keep each long line in one document, as keep bitmaps.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with
A-Z lower-cased. Keys of ``min_chars`` code points or more that occur in two
documents or more lose all their lines except in the smallest doc_id.

Only 128-bit hashes of keys travel. They are range-partitioned and sorted by
hash, document and position; a window over that order streams the first
document of each hash. A line may be in a third of all documents, so the first
pass runs per (hash, document salt): what is not first there is dropped for
good, and one document per salt at most goes on to the second pass, which
finds the first document of the hash. Both passes use the range partitioning
and its sort as they are. Dropped positions are folded into 64-line words,
and a document's bitmap lists only the words that lost a line.
"""

from __future__ import annotations

from typing import List

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwise.llm.common import BLANKS, partitions, stage

MIN_CHARS = 10
SALTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    """Lines between \\n; null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.char_length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_hash, pos`` (from 0) of the lines that go."""
    lines = docs.select(
        "doc_id",
        text_hash(F.col("text")).alias("text_hash"),
        F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("pos", "key"),
    ).filter(F.char_length("key") >= min_chars)
    hashed = lines.select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), F.col("key")).alias("h2"),
        (F.xxhash64("doc_id") % SALTS).cast("int").alias("salt"),
        "doc_id", "text_hash", "pos",
    )
    hashed = stage(hashed, "lines")  # range bounds are sampled in a pass of its own: not over the texts again
    n = partitions(docs)
    doc = F.col("doc_id").asc_nulls_last()

    def first_document(rows: DataFrame, keys: List[str], name: str) -> DataFrame:
        ranged = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys, doc, "pos")
        w = Window.partitionBy(*keys).orderBy(doc, F.col("pos")).rowsBetween(Window.unboundedPreceding, 0)
        return ranged.withColumn(name, F.first("doc_id").over(w))

    once = first_document(hashed, ["h1", "h2", "salt"], "first_in_salt")
    later = ~F.col("doc_id").eqNullSafe(F.col("first_in_salt"))
    # rows already dropped are spread by their salt below -1, the rest of a hash meets under 0
    once = once.withColumn("salt", F.when(later, -1 - F.abs(F.xxhash64("doc_id") % 1024)).otherwise(F.lit(0)).cast("int"))
    twice = first_document(once, ["h1", "h2", "salt"], "first_doc")
    gone = (F.col("salt") < 0) | ~F.col("doc_id").eqNullSafe(F.col("first_doc"))
    return twice.filter(gone).select("doc_id", "text_hash", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, text_hash, words``: for each document that loses a line, the
    64-line words of its keep bitmap that are not all ones, as
    ``array<struct<word int, bits bigint>>`` (bit i of word w: line 64*w+i
    stays). Documents without a row keep all lines.

    Rows with the same doc_id are one document; a null doc_id counts as the
    largest. Documents may repeat: equal rows share a bitmap."""
    gone = dropped_lines(docs.select("doc_id", "text"), min_chars)
    words = gone.groupBy("doc_id", "text_hash", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(
        F.bitwise_not(F.bit_or(F.expr("shiftleft(1L, pos % 64)"))).alias("bits")
    )
    return words.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut down to the kept lines, joined by \\n, plus
    ``n_lines`` (before) and ``n_dropped``. Other columns stay as they are."""
    docs = docs.drop("n_lines", "n_dropped")
    b = bitmaps.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), F.col("words").alias("__words"))
    rows = docs.withColumn("__text_hash", text_hash(F.col("text")))
    # the hash is never null, so the null-safe id can ride along in the same equi-join
    joined = rows.join(b, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text_hash") == F.col("__hash")), "left")
    kept = F.expr(
        "transform(filter(transform(__lines, (x, i) -> struct(x AS line, i AS pos)), "
        "r -> (coalesce(element_at(__map, cast(r.pos div 64 AS int)), -1L) & shiftleft(1L, r.pos % 64)) != 0), r -> r.line)"
    )
    out = (
        joined.withColumn("__lines", split_lines(F.col("text")))
        .withColumn("__map", F.map_from_entries("__words"))
        .withColumn("__kept", F.when(F.col("__words").isNull(), F.col("__lines")).otherwise(kept))
        .withColumn("n_lines", F.size("__lines").cast("long"))
        .withColumn("n_dropped", (F.size("__lines") - F.size("__kept")).cast("long"))
        .withColumn("text", F.when(F.col("__words").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join("__kept", "\n")))
    )
    return out.select(*docs.columns, "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines removed, plus ``n_lines, n_dropped``. Null
    text becomes empty; an empty table stays empty."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, row_id, l.pos, l.line,
    translate(trim(l.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, row_number() OVER () AS row_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents) d,
    LATERAL (SELECT unnest(a) AS line, generate_subscripts(a, 1) AS pos) l
),
keys AS (SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT lines.*, first_doc IS NOT NULL AND doc_id <> first_doc AS gone FROM lines LEFT JOIN keys USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id, row_id
"""
