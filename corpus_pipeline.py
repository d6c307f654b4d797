"""A corpus from raw documents to packed training sequences.

Five stages, each one operator over all that the stage before kept. Every
stage but the last returns the columns of documents, extra ones included."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwise.llm import language, line_dedup, mixing, near_dup, packing
from ledgerwise.llm.common import stage
from ledgerwise.llm.vocab import default_path

#: Mean posterior under which no language is dominant.
MIN_SCORE = 0.3


def _carried(docs: DataFrame) -> DataFrame:
    """What operators read, and the other columns beside it under one name, so
    that extra ones cannot clash with theirs. The text is there only once."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__row"))


def _restored(rows: DataFrame, columns: Sequence[str], **changed) -> DataFrame:
    changed = {"text": F.col("text"), **changed}
    return rows.select(*[(changed[c] if c in changed else F.col("__row").getField(c)).alias(c) for c in columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a dominant language, go. A null
    lang is filled with the prediction. Without a single labelled document
    there is nothing to tell languages by, and all stay."""
    model = language.fit(docs)
    if not model.languages:
        return docs
    found = language.identify(_carried(docs), model).filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return _restored(found, docs.columns, lang=F.coalesce(F.col("__row").getField("lang"), F.col("lang_pred")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in the smallest doc_id only."""
    kept = line_dedup.dedup_lines(_carried(docs))
    return _restored(kept, docs.columns, n_chars=F.char_length("text").cast("long"))


#: Ids of further texts under one doc_id lie from here on, above real ones.
EXTRA = 1 << 62


def _units(docs: DataFrame) -> DataFrame:
    """``unit``, ``text``, ``__row`` and ``__order`` (a hash of the row): every text of
    a doc_id is a unit of its own. The least digest keeps the doc_id, the others get
    an id of their hash."""
    docs = docs.filter(F.col("doc_id").isNotNull())
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    texts = docs.groupBy("doc_id").agg(F.min(digest).alias("__least"), F.max(digest).alias("__most"))
    several = stage(texts.filter("__least < __most").select("doc_id", "__least"), "several")  # staged: its size decides the join
    own = _carried(docs).join(several, "doc_id", "left")
    extra = F.col("__least").isNotNull() & (digest != F.col("__least"))
    other = F.xxhash64("doc_id", digest).bitwiseAND(F.lit(EXTRA - 1)).bitwiseOR(F.lit(EXTRA))
    hashable = [F.col("__row").getField(f.name) for f in docs.schema if f.name != "text" and "map<" not in f.dataType.simpleString()]
    order = F.xxhash64(F.col("text").isNull(), *hashable)
    return own.select(F.when(extra, other).otherwise(F.col("doc_id")).alias("unit"), "text", "__row", order.alias("__order"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group stays, once. Different texts under one
    doc_id are compared like those of different documents: of a group, a text
    whose doc_id has it alone stays before others. Rows without an id have no
    group and stay."""
    units = _units(docs)
    kept = near_dup.near_duplicates(units.select(F.col("unit").alias("doc_id"), "text")).filter(F.col("kept"))
    kept = stage(kept.select(F.col("doc_id").alias("unit")).distinct(), "kept")
    own = units.join(kept, "unit", "left_semi").groupBy("unit").agg(F.min_by(F.struct("text", "__row"), "__order").alias("own"))
    return _restored(own.select("own.text", "own.__row"), docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document appears once for every epoch that takes words of it,
    cut down to those words."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences."""
    return packing.pack(packing.token_pieces(docs, tokenizer=default_path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models, hashed signatures and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
