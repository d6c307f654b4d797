"""Harmonic packing of token sequences.

A document is cut into full sequences and a tail; the tail is cut into pieces
whose lengths fit a reciprocal of the capacity: a piece of class k has length
r with k*r just under the capacity, and a bin of the class holds exactly k
pieces of one length. Bins never look at each other, so every worker fills its
own: a piece's bin and offset follow from its number within its length. Only
the counts per (length, bucket) are summed up first. The last, unfilled bins of
the lengths (at most one per length, whatever the input) are packed together.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from functools import lru_cache
from typing import Dict, Iterator, List, Optional, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwise.llm.common import give_back, partitions, running_offsets, stage, text_batches
from ledgerwise.llm.vocab import default_path, encoding

CAPACITY = 1024
END_ID = 0
#: A piece may leave 1/SLACK of its bin empty before it is cut once more.
SLACK = 64
CACHED_WORDS = 300_000
CACHED_LENGTH = 64

# array("I") below is the machine's order: little-endian wherever Spark runs.
# A space next to other white space, or at an end: the text is then encoded whole.
IRREGULAR = re.compile(r"\s | \s|^ | $")


class WordIds(dict):
    """word -> its ids as little-endian uint32 bytes; a bounded cache."""

    def __init__(self, enc, prefix: str):
        super().__init__()
        self.enc, self.prefix = enc, prefix

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.enc.encode_ordinary(self.prefix + word)).tobytes()
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = ids
        return ids


def added_tokens(tokenizer: str) -> Dict[str, int]:
    """The tokens that a tokenizer's json matches as they are, anywhere in a text."""
    with open(tokenizer, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    plain = {t["content"]: t["id"] for t in added if not (t["single_word"] or t["lstrip"] or t["rstrip"])}
    if len(plain) < len(added):
        raise ValueError(f"{tokenizer}: added tokens that take blanks or whole words only are not supported")
    return plain


class Encoder:
    """Whole texts to ids. A single space between non-blanks always starts a
    new pre-token of this vocabulary's pattern, so words can be encoded one by
    one and remembered. Texts are cut at ``added`` tokens, leftmost and longest
    first, and the stretches between are texts of their own."""

    def __init__(self, vocab: str, added: Optional[Dict[str, int]] = None):
        self.enc = encoding(vocab)
        self.first, self.later = WordIds(self.enc, ""), WordIds(self.enc, " ")
        self.added = {t: np.array([i], dtype="<u4").tobytes() for t, i in (added or {}).items()}
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def ids(self, text: str) -> bytes:
        if not any(t in text for t in self.added):
            return self.plain(text)
        # every other stretch is an added token
        return b"".join(self.added[t] if i % 2 else self.plain(t) for i, t in enumerate(self.cuts.split(text)) if t)

    def plain(self, text: str) -> bytes:
        if IRREGULAR.search(text):
            return np.array(self.enc.encode_ordinary(text), dtype="<u4").tobytes()
        head, *rest = text.split(" ")
        return self.first[head] + b"".join(map(self.later.__getitem__, rest))


@lru_cache(maxsize=None)
def tail_pieces(tail: int, capacity: int = CAPACITY) -> Tuple[int, ...]:
    """Lengths that a tail shorter than the capacity is cut into."""
    cuts: List[int] = []
    while tail > 0:
        if capacity - (capacity // tail) * tail <= capacity // SLACK:
            cuts.append(tail)
            break
        cuts.append(capacity // -(-capacity // tail))
        tail -= cuts[-1]
    return tuple(cuts)


def cut_document(n: int, capacity: int = CAPACITY) -> List[int]:
    return [capacity] * (n // capacity) + list(tail_pieces(n % capacity, capacity))


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(
    docs: DataFrame, vocab: Optional[str] = None, capacity: int = CAPACITY, with_ids: bool = False, tokenizer: Optional[str] = None
) -> DataFrame:
    """The pieces of every document (null text: empty), END_ID closing each;
    with ``ids`` as array<int> when asked for. The added tokens of the
    ``tokenizer`` json are matched in texts, as tokenizers does by default;
    without it, they are text like any other."""
    path = vocab or default_path("byte_bpe_50k.tiktoken")
    added = added_tokens(tokenizer) if tokenizer else {}

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(path, added)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows: List[tuple] = []
            for doc_id, known, text in zip(batch["doc_id"], batch["known"], batch["text"]):
                ids = encoder.ids(text or "") + end
                n, start = len(ids) // 4, 0
                key = int(doc_id) if known else None
                for length in cut_document(n, capacity):
                    own = ids[4 * start : 4 * (start + length)]
                    row = (key, start, length, zlib.crc32(own), n)
                    rows.append(row + (np.frombuffer(own, "<u4").astype("int32"),) if with_ids else row)
                    start += length
                if len(rows) >= 20_000:
                    yield frame(rows)
                    rows = []
            yield frame(rows)
            give_back()

    def frame(rows: List[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids, dtype=object)
        return out.astype({"doc_id": "Int64", **{c: "int64" for c in ("start", "length", "ids_crc32", "doc_tokens")}})

    # without nulls, ids stay integers on their way through pandas
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("doc_id").isNotNull().alias("known"), "text")
    return text_batches(keyed).mapInPandas(cut, PIECES + ", ids array<int>" * with_ids)


def pack_leftovers(capacity: int):
    """First-fit decreasing over the unfilled bins: at most one bin per length."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True]).reset_index(drop=True)
        used: List[int] = []
        bins, offsets = [], []
        for length in rows["length"]:
            b = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if b == len(used):
                used.append(0)
            bins.append(b)
            offsets.append(used[b])
            used[b] += length
        rows["sequence_id"] = rows["base"] + np.array(bins, dtype="int64")
        rows["offset"] = np.array(offsets, dtype="int64")
        return rows

    return pack


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns; ``length`` between 1 and the capacity, and the
    columns of PIECES) plus ``sequence_id`` and ``offset``.

    Deterministic for the same rows; equal rows are interchangeable. An empty
    table stays empty."""
    cols = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = stage(pieces.select(*cols), "pieces")
    buckets = max(64, partitions(pieces))
    bucket = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int")
    per_bin = F.floor(F.lit(capacity) / F.col("length")).cast("long")

    totals = pieces.groupBy("length", bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
    firsts = running_offsets(totals, "__n", ["__bucket"], ["length"])
    lengths = totals.groupBy("length").agg(F.sum("__n").alias("__total")).withColumn("__bins", F.floor(F.col("__total") / per_bin))
    bases = running_offsets(lengths, "__bins", ["length"]).select(
        "length", F.col("first").alias("__base"), "__bins", F.sum("__bins").over(Window.partitionBy()).alias("__all")
    )
    plan = firsts.join(bases, "length").select("length", "__bucket", "first", "__base", "__bins", "__all")

    w = Window.partitionBy("length", "__bucket").orderBy("doc_id", "start", "ids_crc32")
    numbered = pieces.withColumn("__bucket", bucket).withColumn("__no", F.row_number().over(w) - 1)
    # plan: lengths (under capacity) x buckets rows, whatever the input
    placed = numbered.join(F.broadcast(plan), ["length", "__bucket"]).withColumn("__no", F.col("first") + F.col("__no"))
    bin_no = F.floor(F.col("__no") / per_bin)
    placed = placed.withColumn("__bin", bin_no)
    full = placed.filter(F.col("__bin") < F.col("__bins")).select(
        *cols,
        (F.col("__base") + F.col("__bin")).cast("long").alias("sequence_id"),
        ((F.col("__no") % per_bin) * F.col("length")).cast("long").alias("offset"),
    )
    rest = placed.filter(F.col("__bin") >= F.col("__bins")).select(*cols, F.col("__all").cast("long").alias("base"))
    rest = rest.withColumn("doc_id", F.col("doc_id").cast("string"))  # a null would make the ids floats in pandas
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields)
    rest = rest.groupBy("base").applyInPandas(pack_leftovers(capacity), f"{schema}, sequence_id long, offset long")
    rest = rest.withColumn("doc_id", F.col("doc_id").cast("long"))
    return full.unionByName(rest.select(*cols, "sequence_id", "offset"))


def op5_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(token_pieces(docs, tokenizer=default_path("byte_bpe_50k.json"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )
