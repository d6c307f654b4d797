"""Strict-schema NDJSON ingest that keeps every malformed line.

Lines are read with the ``text`` source and parsed with ``from_json`` in
PERMISSIVE mode with an explicit corrupt-record column. Because the parser
options are set, Catalyst does not prune the parse schema, so whether a line
counts as corrupt never depends on which columns a query reads. Text files
split like any other file, and the raw line and its file path travel with the
row without caching the input.
"""

from __future__ import annotations

from typing import Tuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerwise import constants as C


# A line of characters up to U+0020 only is blank to the JSON source.
NOT_BLANK = r"[^\x00-\x20]"


def with_corrupt_column(schema: StructType, corrupt_col: str = C.CORRUPT_COL) -> StructType:
    """Append the corrupt-record column to a schema."""
    return StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])


def parse_json_lines(
    lines: DataFrame,
    schema: StructType,
    corrupt_col: str = C.CORRUPT_COL,
    line_col: str = "value",
) -> DataFrame:
    """Parse a column of NDJSON lines against ``schema``.

    Output: the schema's fields, ``corrupt_col`` (the raw line when it did not
    parse), plus any other input columns (e.g. ``source_file``). Blank lines
    are skipped, as the JSON file source does.
    """
    full = with_corrupt_column(schema, corrupt_col)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col}
    other = [c for c in lines.columns if c != line_col]
    # The parse runs inside a one-element explode: Catalyst does not push a
    # filter on a generator's output below it, so a later "corrupt or not"
    # filter cannot make every line be parsed twice.
    parsed = lines.filter(F.col(line_col).rlike(NOT_BLANK)).select(
        F.explode(F.array(F.from_json(F.col(line_col), full, options))).alias("_j"),
        F.col(line_col).alias("_line"),
        *other,
    )
    # A line that is JSON but not an object (e.g. `null`, an array) parses to a
    # NULL struct: treat it as corrupt too.
    fields = [F.col("_j")[f.name].alias(f.name) for f in schema.fields]
    corrupt = F.when(F.col("_j").isNull(), F.col("_line")).otherwise(F.col("_j")[corrupt_col])
    return parsed.select(*fields, corrupt.alias(corrupt_col), *other)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of the file(s) at ``path``: ``value, source_file``."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_json_strict(
    spark: SparkSession, path: str, schema: StructType, corrupt_col: str = C.CORRUPT_COL
) -> DataFrame:
    """Read NDJSON file(s) at ``path`` against ``schema``; adds ``source_file``."""
    return parse_json_lines(read_lines(spark, path), schema, corrupt_col)


def split_corrupt(df: DataFrame, corrupt_col: str = C.CORRUPT_COL) -> Tuple[DataFrame, DataFrame]:
    """``(clean, corrupt)``: clean drops the corrupt column; corrupt is
    ``raw_payload, source_file``."""
    bad = F.col(corrupt_col).isNotNull()
    clean = df.filter(~bad).drop(corrupt_col)
    source = F.col("source_file") if "source_file" in df.columns else F.lit(None).cast("string")
    corrupt = df.filter(bad).select(F.col(corrupt_col).alias("raw_payload"), source.alias("source_file"))
    return clean, corrupt


def load_transactions(spark: SparkSession, path: str) -> Tuple[DataFrame, DataFrame]:
    """Transaction NDJSON -> ``(clean, corrupt)``. No action is run."""
    return split_corrupt(read_json_strict(spark, path, C.TRANSACTION_SCHEMA))


def load_ledger(spark: SparkSession, path: str) -> Tuple[DataFrame, DataFrame]:
    """Ledger NDJSON -> ``(clean, corrupt)``. No action is run."""
    return split_corrupt(read_json_strict(spark, path, C.LEDGER_SCHEMA))
