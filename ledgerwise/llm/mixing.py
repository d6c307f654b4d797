"""Mixing sources to target weights, in blocks of words.

Every source is a stream of words: its documents in hashed order, one after
another, cut into blocks of ``block_words``. The mix needs a number of words of
each source, hence a number of block slots. Every output shard has an equal share
of all slots and draws its source counts from one multinomial with those numbers
as odds; running sums over the shards number each source's slots, and the places
of a source drawn beyond its number go to those drawn too seldom. Slot i
of a source is block ``permutation(i mod blocks)`` in epoch ``i div blocks``:
every epoch uses each block once, and no block is used more often than the
epochs, so no document exceeds the cap. Blocks and documents meet by block
number, and every range of words keeps the output shard and slot it is for.
"""

from __future__ import annotations

import re
from typing import Iterator, List, Sequence, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwise.llm.common import give_back, partitions, running_offsets, stage, text_batches
from ledgerwise.llm.sharding import permute, unpermute

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
BLOCK_WORDS = 256
OUTPUT_SHARDS = 64
BUCKETS = 256
#: Slots of one range, and copies of one row, that are written out at a time.
CHUNK = 65_536
COPY_CHUNK = 10_000
WORD = re.compile(r"[^\x20\x09-\x0D]+")
KEY = ["doc_id", "source", "text_hash"]


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``source, source_size, target``, one row per source. Sources by code
    point with null last take the weights in turn. A target is
    min(cap * size, level * weight); the level at which the targets sum to
    all sizes is what resharing the excess ends in, and it is found in one
    pass over the sources by the ratio at which they reach their cap."""
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    sources = sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * cap).cast("double").alias("most"))
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    sources = sources.withColumn("level", level)
    open_ = F.when(F.col("most") >= F.col("level") * F.col("weight"), F.col("level"))
    # the first source that stays below its cap sets the level
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sources = sources.withColumn("level", F.first(open_, ignorenulls=True).over(whole))
    return sources.select("source", "source_size", F.least("most", F.col("level") * F.col("weight")).alias("target"))


def draw_shard(shards: int, seed: int):
    """The source counts of one output shard: a multinomial draw of its share of
    all slots, with the sources' slots as odds. ``own`` has every source."""

    def run(own: pd.DataFrame) -> pd.DataFrame:
        names = [None if pd.isna(x) else x for x in own["source"]]
        own = own.iloc[sorted(range(len(own)), key=lambda i: (names[i] is None, (names[i] or "").encode("utf-8", "surrogatepass")))]
        shard, n = int(own["shard"].iloc[0]), own["n"].to_numpy("int64")
        total = int(n.sum())
        rng = np.random.Generator(np.random.PCG64([seed, shard]))
        return own.assign(count=rng.multinomial(total // shards + (shard < total % shards), n / total))

    return run


def drawn_counts(sources: DataFrame, shards: int = OUTPUT_SHARDS, seed: int = 7) -> DataFrame:
    """``source, n, shard, count`` for ``sources(source, n)``: what each output
    shard draws of each source; a shard is one task of a row per source."""
    dealt = sources.select("source", "n", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    return dealt.groupBy("shard").applyInPandas(draw_shard(shards, seed), "source string, n long, shard int, count long")


def _numbers(ranges: DataFrame, first: str, count: str, name: str) -> DataFrame:
    """A row for every number of every range, ``name`` beside the range's columns.
    Long ranges are cut into chunks that are spread over the tasks."""
    end = F.col(first) + F.col(count)
    chunks = ranges.filter(F.col(count) > 0).withColumn("__end", end)
    chunks = chunks.withColumn("__from", F.explode(F.sequence(F.col(first), end - 1, F.lit(CHUNK).cast("long"))))
    chunks = chunks.repartition(partitions(ranges), *[c for c in ("source", "shard") if c in ranges.columns], "__from")
    return chunks.withColumn(name, F.explode(F.sequence("__from", F.least(F.col("__from") + CHUNK, F.col("__end")) - 1))).drop("__from", "__end")


def dealt_slots(sources: DataFrame, shards: int = OUTPUT_SHARDS, seed: int = 7) -> DataFrame:
    """``source, shard, slot``: slots 0..n-1 of every source of ``sources(source,
    n)``, each in one output shard, all shards of equal size but for one slot.

    Running sums over the shards' draws (in an order of the source's own) number a
    source's slots. Where the draws name more slots than a source has, those
    places go to the sources that were drawn too seldom, so that targets and the
    cap hold on small inputs too; their share falls with the square root of the size."""
    cells = stage(drawn_counts(sources.filter("n > 0"), shards, seed), "draws")
    turn = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "shard"), "shard")  # one row per shard
    cells = cells.withColumn("first", F.coalesce(F.sum("count").over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long"))
    cells = cells.withColumn("kept", F.greatest(F.lit(0), F.least("count", F.col("n") - F.col("first"))).cast("long"))
    own = _numbers(cells.select("source", "shard", "first", "kept"), "first", "kept", "slot")

    open_places = cells.groupBy("shard").agg(F.sum(F.col("count") - F.col("kept")).cast("long").alias("open"))
    open_places = running_offsets(open_places, "open", ["shard"]).withColumnRenamed("first", "number")
    seldom = cells.groupBy("source").agg(F.first("n").alias("n"), F.least(F.first("n"), F.sum("count")).cast("long").alias("drawn"))
    seldom = seldom.select("source", "drawn", (F.col("n") - F.col("drawn")).alias("missing"))
    seldom = running_offsets(seldom, "missing", ["source"]).withColumnRenamed("first", "number")  # a row per source
    places = _numbers(open_places, "number", "open", "no").select("no", "shard")
    waiting = _numbers(seldom, "number", "missing", "no").select("no", "source", (F.col("drawn") + F.col("no") - F.col("number")).alias("slot"))
    return own.select("source", "shard", "slot").unionByName(waiting.join(places, "no").select("source", "shard", "slot"))


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = 7) -> DataFrame:
    """``source, shard, slot, epoch, block, take``: the mix as blocks, where
    ``take`` words from the block's start are used (all of it, but for the
    slot that reaches the target)."""
    s = sources.filter(F.col("source_size") > 0).select(
        "source", "source_size",
        F.least(F.round("target").cast("long"), F.col("source_size") * CAP).alias("words"),
        F.ceil(F.col("source_size") / block_words).cast("long").alias("blocks"),
    )
    s = s.withColumn("epochs", F.floor(F.col("words") / F.col("source_size"))).withColumn("rest", F.col("words") % F.col("source_size"))
    s = s.withColumn("short", F.col("blocks") * block_words - F.col("source_size"))  # words missing from the last block

    def key(epoch: Column) -> Column:
        return F.concat_ws(":", F.lit(str(seed)), F.coalesce("source", F.lit("")), epoch.cast("string"))

    s = s.withColumn("short_at", unpermute(F.col("blocks") - 1, F.col("blocks"), key(F.col("epochs"))))
    partial = F.least("blocks", F.ceil((F.col("rest") + F.col("short")) / block_words))
    s = s.withColumn("n", (F.col("epochs") * F.col("blocks") + F.when(F.col("rest") > 0, partial).otherwise(0)).cast("long"))
    s = stage(s.withColumnRenamed("source", "__source"), "sizes")  # one row per source
    dealt = dealt_slots(s.select(F.col("__source").alias("source"), "n"), shards, seed)
    s = dealt.join(s, F.col("source").eqNullSafe(F.col("__source")))
    s = s.withColumn("epoch", F.floor(F.col("slot") / F.col("blocks"))).withColumn("turn", F.col("slot") % F.col("blocks"))
    s = s.withColumn("block", permute(F.col("turn"), F.col("blocks"), key(F.col("epoch"))))
    length = F.lit(block_words) - F.when(F.col("block") == F.col("blocks") - 1, F.col("short")).otherwise(0)
    before = F.col("turn") * block_words - F.when(F.col("short_at") < F.col("turn"), F.col("short")).otherwise(0)
    take = F.when(F.col("epoch") < F.col("epochs"), length).otherwise(F.least(length, F.col("rest") - before))
    return s.withColumn("take", take.cast("long")).filter(F.col("take") > 0).select("source", "shard", "slot", "epoch", "block", "take")


def word_streams(sized: DataFrame) -> DataFrame:
    """``sized`` plus ``copy`` (number among equal KEYs) and ``first_word``,
    the document's place in its source's stream. Equal rows are counted first and
    then stand in chunks of COPY_CHUNK; chunks are numbered in hash buckets, so
    neither a source nor a row with a third of all words is one task."""
    runs = sized.groupBy(*sized.columns).agg(F.count(F.lit(1)).alias("copies"))
    chunks = runs.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPY_CHUNK).cast("long"))))
    chunks = chunks.withColumn("held", F.least(F.lit(COPY_CHUNK), F.col("copies") - F.col("from")))
    chunks = chunks.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash", "from"), F.lit(BUCKETS)).cast("int"))
    words = F.col("size") * F.col("held")
    totals = chunks.groupBy("source", "bucket").agg(F.sum(words).alias("words"))
    firsts = running_offsets(totals, "words", ["bucket"], ["source"]).withColumnRenamed("source", "__source").withColumnRenamed("bucket", "__bucket")
    w = Window.partitionBy("source", "bucket").orderBy("doc_id", "text_hash", "from").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("before", F.coalesce(F.sum(words).over(w), F.lit(0)))
    joined = chunks.join(firsts, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")))
    rows = joined.select(*sized.columns, "from", (F.col("first") + F.col("before")).alias("at"), F.explode(F.sequence("from", F.col("from") + F.col("held") - 1)).alias("copy"))
    return rows.select(*sized.columns, "copy", (F.col("at") + (F.col("copy") - F.col("from")) * F.col("size")).alias("first_word"))


def taken_ranges(streams: DataFrame, plan: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """KEY, copy, epoch, shard, slot, lo, hi: the word ranges that the mix takes
    from each document, and where they go, joined by (source, block)."""
    last = F.col("first_word") + F.col("size") - 1
    parts = streams.filter(F.col("size") > 0).withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("first_word") / block_words), F.floor(last / block_words)))
    )
    p = plan.select(F.col("source").alias("__source"), F.col("block").alias("__block"), "epoch", "shard", "slot", "take")
    # both sides grow with the input, which Spark cannot see before the slots are made
    met = parts.hint("merge").join(p.hint("merge"), F.col("source").eqNullSafe(F.col("__source")) & (F.col("block") == F.col("__block")))
    start = F.col("block") * block_words
    lo = F.greatest(start - F.col("first_word"), F.lit(0))
    hi = F.least(start + F.col("take") - F.col("first_word"), F.col("size"))
    return met.select(*KEY, "copy", "epoch", "shard", "slot", lo.alias("lo"), hi.alias("hi")).filter(F.col("hi") > F.col("lo"))


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", text_hash("text").alias("text_hash"), word_count(F.col("text")).alias("size"))


def _same(a: str, b: str) -> Column:
    cond = F.lit(True)
    for c in KEY:
        cond = cond & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return cond


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = OUTPUT_SHARDS, seed: int = 7) -> Tuple[DataFrame, DataFrame, DataFrame]:
    """(streams, sources, ranges) of the mix of ``docs(doc_id, source, text)``."""
    streams = stage(word_streams(stage(sized_documents(docs), "sizes")), "streams")
    sources = stage(source_targets(streams), "sources")
    return streams, sources, taken_ranges(streams, slots(sources, block_words, shards, seed), block_words)


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, places`` per document
    row; places are the (shard, slot, lo, hi) its words go to, in that order.
    Null text has no words; an empty table stays empty."""
    streams, sources, ranges = mix(docs, **options)
    places = F.sort_array(F.collect_list(F.struct(F.col("shard").cast("int").alias("shard"), "slot", "lo", "hi"))).alias("places")
    taken = ranges.groupBy(*KEY, "copy").agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"), places)
    rows = streams.alias("d").join(taken.alias("t"), _same("d", "t") & (F.col("d.copy") == F.col("t.copy")), "left")
    rows = rows.select("d.doc_id", "d.source", "d.size", F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("t.places", F.array()).alias("places"))
    # one row per source
    out = rows.alias("r").join(sources.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")), "left")
    return out.select("r.doc_id", "r.source", "r.size", "s.source_size", "s.target", "r.taken", "r.places")


def cut_words(text: str, ranges: List[Tuple[int, int]]) -> str:
    """The words of the ranges with the blanks between them; ranges that do
    not touch are joined by \\n. All words: the text as it is."""
    spans = [m.span() for m in WORD.finditer(text)]
    merged: List[List[int]] = []
    for lo, hi in sorted(ranges):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    if merged == [[0, len(spans)]]:
        return text
    return "\n".join(text[spans[lo][0] : spans[hi - 1][1]] for lo, hi in merged)


@F.pandas_udf(T.StringType())
def cut_text(text: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
    out = pd.Series([cut_words(t, list(zip(a, b))) for t, a, b in zip(text, lo, hi)], dtype=object)
    give_back()
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def cut_parts(text: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
    out = []
    for t, a, b in zip(text, lo, hi):
        spans = [m.span() for m in WORD.finditer(t)]
        out.append([t[spans[x][0] : spans[y - 1][1]] for x, y in zip(a, b)])
    return pd.Series(out, dtype=object)


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: one row per document row
    and epoch that the mix takes words from, ``text`` cut down to them (whole
    when all are taken) and ``n_chars``, where present, set to its length.
    Documents without a taken word are left out."""
    _, _, ranges = mix(docs, **options)
    by_epoch = ranges.groupBy(*KEY, "copy", "epoch").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("at"))
    changed = {"text": F.col("__cut"), "n_chars": F.char_length("__cut").cast("long")}
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in changed]).alias("__row")
    # one struct as the key (its nulls are equal): texts move once, to be deduplicated and joined.
    # Both sides need one type: a staged hash is nullable, so it is made what it was
    texts = docs.select(F.struct("doc_id", "source", text_hash("text").alias("text_hash")).alias("__key"), "text", rest).dropDuplicates(["__key"])
    ranged = F.struct("doc_id", "source", F.coalesce("text_hash", F.lit(0).cast("long")).alias("text_hash"))
    met = texts.join(by_epoch.select(ranged.alias("__key"), "at"), "__key")
    cut = text_batches(met).select("__row", cut_text("text", "at.lo", "at.hi").alias("__cut"))
    return cut.select(*[(changed[c] if c in changed else F.col("__row").getField(c)).alias(c) for c in docs.columns])


def mix_shards(docs: DataFrame, **options) -> DataFrame:
    """The mix by output shard: ``shard, slot, source, epoch, doc_id, lo, hi,
    text``, one row per slot and document that it takes words ``lo`` to ``hi``
    of. A shard lies in one partition, in the order of its slots; within a slot
    number the sources follow by code point, and the words of a block as they
    stand in the source's stream."""
    streams, _, ranges = mix(docs, **options)
    ranges = ranges.alias("r").join(streams.alias("s"), _same("r", "s") & (F.col("r.copy") == F.col("s.copy")))
    at = F.struct("r.shard", "r.slot", "r.epoch", "r.lo", "r.hi", "s.first_word")
    by_text = ranges.groupBy(*[F.col(f"r.{c}") for c in KEY], F.col("r.copy")).agg(F.collect_list(at).alias("at"))
    texts = docs.select("doc_id", "source", text_hash("text").alias("text_hash"), "text").dropDuplicates(KEY)
    met = texts.alias("d").join(by_text.alias("e"), _same("d", "e")).select("d.doc_id", "d.source", "d.text", "e.at")
    cut = text_batches(met).select("doc_id", "source", "at", cut_parts("text", "at.lo", "at.hi").alias("part"))
    rows = cut.select("doc_id", "source", F.explode(F.arrays_zip("at", "part")).alias("p"))
    rows = rows.select("p.at.shard", "p.at.slot", "source", "p.at.epoch", "doc_id", "p.at.lo", "p.at.hi", F.col("p.part").alias("text"), "p.at.first_word")
    ordered = rows.repartition(partitions(rows), "shard").sortWithinPartitions("shard", "slot", "source", F.col("first_word") + F.col("lo"))
    return ordered.drop("first_word")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return mix_report(docs).select(
        "doc_id", "size", "source_size", "target", "taken", "source",
        F.array_join(F.transform("places", lambda p: F.concat_ws(":", p["shard"], p["slot"], p["lo"], p["hi"])), ",").alias("places"),
    )
