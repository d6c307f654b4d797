"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizations of one text are cut into groups at the byte offsets where
tokens of both end. Tokens of the two sides whose bytes overlap are linked. How
much two token ids belong together is told by the number of documents that hold
them linked:

* Documents are taken in chunks, wherever they lie. A chunk has, for every id
  pair, a compressed bitmap of its documents: multiplicity planes (plane k holds
  the documents whose number of links has bit k) as short offset lists or as
  bit sets, whichever is smaller.
* OR over the planes of a pair is the bitmap of its documents; its popcount is
  the chunk's share of the pair's document count, and the shares are summed up
  by a map-side combined aggregate. A pair in every document is one row per
  chunk, never one row per document.
* Counts go back to the chunks that have the pair, and the postings return them
  to the documents, plane by plane: a plane of bit k adds its pair's score 2**k
  times to every document in it.

Words met again are aligned once: a single space between other characters
starts a token on both sides, so the alignment of a text is that of its words.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache
from typing import Dict, Iterator, List, Optional, Sequence, Tuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.bpe import Recent
from ledgerwise.llm.common import stage
from ledgerwise.llm.vocab import default_path, encoding, ranks

WORD_CUT = re.compile(r"(?<=\S) (?=\S)")
IRREGULAR = re.compile(r"\s | \s|^ | $")
#: An id pair is one number: a * SPAN + b.
SPAN = 1 << 20
#: A chunk ends with its CHUNK-th document, or with the document that brings it to LINKS links.
CHUNK = 1 << 13
LINKS = 4_000_000
#: Words of the texts whose new words are aligned together.
WORDS = 100_000
SET_BYTES = CHUNK // 8


# --- tokenizers ------------------------------------------------------------------


class Sides:
    """Both tokenizers, and text, bytes and length of their ids. A's ids are
    those of the ranks that hold the same vocabulary."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = encoding(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8") for i, p in enumerate(pieces)]
        self.length_a = [0] * self.a.n_vocab
        for token, i in ranks(path_a).items():
            self.length_a[i] = len(token)
        self.length_b = [len(p) for p in self.bytes_b]
        self.names = [str(i) for i in range(max(self.a.n_vocab, len(pieces)))]
        #: whether a token never spans the start of a word
        self.by_word = not any("▁" in p.lstrip("▁") for p in pieces)

    def aligned(self, texts: List[str]) -> List[Optional["Aligned"]]:
        """None for a text whose B tokens do not spell space + text; A's always do."""
        encode, piece = self.a.encode_ordinary, self.bytes_b.__getitem__
        out: List[Optional[Aligned]] = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            spelled = " " + text
            same = b"".join(map(piece, b)) == spelled.encode("utf-8")
            out.append(self.align(encode(spelled), b) if same else None)
        return out

    def align(self, a: List[int], b: List[int]) -> "Aligned":
        """Two tokenizations of the same bytes, walked side by side."""
        length_a, length_b, names = self.length_a, self.length_b, self.names
        groups, keys = [], []
        i = j = 0
        ahead = length_a[a[0]] - length_b[b[0]]  # bytes that A's token ends behind B's
        own_a, own_b = names[a[0]], names[b[0]]
        while True:
            keys.append(a[i] * SPAN + b[j])
            if ahead == 0:
                groups.append(own_a + "|" + own_b)
                i += 1
                j += 1
                if i == len(a):
                    break
                ahead = length_a[a[i]] - length_b[b[j]]
                own_a, own_b = names[a[i]], names[b[j]]
            elif ahead < 0:
                i += 1
                ahead += length_a[a[i]]
                own_a += "," + names[a[i]]
            else:
                j += 1
                ahead -= length_b[b[j]]
                own_b += "," + names[b[j]]
        return ";".join(groups), array("q", keys).tobytes(), (len(a), len(b), len(groups), len(keys))


#: groups as text, pair numbers as int64 bytes, and n_a, n_b, n_groups, n_links
Aligned = Tuple[str, bytes, Tuple[int, int, int, int]]


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> Sides:
    return Sides(path_a, path_b)


class Aligner:
    """Texts to alignments, words met again from a bounded cache."""

    def __init__(self, both: Sides):
        self.both, self.known = both, Recent()

    def texts(self, texts: Sequence[Optional[str]]) -> Iterator[Optional[Tuple[str, np.ndarray, List[int]]]]:
        """Per text groups_sha256, pair numbers and the four counts; None without
        tokens. New words of some texts at a time are aligned together."""
        waiting: List[List[str]] = []
        size = 0
        for text in texts:
            if not text:
                words: List[str] = []
            elif not self.both.by_word:
                words = [text]
            else:
                words = WORD_CUT.split(text) if IRREGULAR.search(text) else text.split(" ")
            waiting.append(words)
            size += len(words)
            if size >= WORDS:
                yield from self._texts(waiting)
                waiting, size = [], 0
        yield from self._texts(waiting)

    def _texts(self, texts: List[List[str]]):
        """No piece of B has more bytes than what it stands for, so a text is
        spelled by all its words or not at all."""
        known = {w: self.known.get(w) for words in texts for w in words}
        new = [w for w, found in known.items() if found is None]
        for word, found in zip(new, self.both.aligned(new)):
            known[word] = found or False
            self.known.put(word, known[word])
        for words in texts:
            found = [known[w] for w in words]
            if not found or not all(found):
                yield None
                continue
            groups = hashlib.sha256(";".join([f[0] for f in found]).encode()).hexdigest()
            counts = np.array([f[2] for f in found], "int64").sum(axis=0)
            yield groups, np.frombuffer(b"".join([f[1] for f in found]), "int64"), counts.tolist()


# --- a chunk and its postings ----------------------------------------------------------

DOCS = ["n_a", "n_b", "n_groups", "n_links"]
CHUNKS = (
    "chunk long, doc_id array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>,"
    " keys array<long>, docs array<int>, owner binary, bit binary, size binary, lists binary, sets binary"
)


def postings(keys: np.ndarray, owners: np.ndarray) -> Dict[str, object]:
    """Links (pair number, document offset) as planes of compressed bitmaps.

    ``keys`` and ``docs``: the pairs and how many documents have them (the popcount of
    OR over the planes). Per plane: ``owner`` (index of its pair), ``bit``,
    ``size`` (documents); the offsets of small planes follow each other in ``lists``,
    the bit sets of the others in ``sets``."""
    entries, times = np.unique(keys * CHUNK + owners, return_counts=True)
    pair, offset = entries // CHUNK, (entries % CHUNK).astype("<u2")
    own, first, docs = np.unique(pair, return_index=True, return_counts=True)
    index = np.repeat(np.arange(len(own)), docs)
    planes: List[Tuple[np.ndarray, ...]] = []
    lists, sets = [], []
    bit = 0
    while len(times) and (times >> bit).any():
        inside = (times >> bit & 1).astype(bool)
        of, at = index[inside], offset[inside]
        owner, size = np.unique(of, return_counts=True)
        dense = size * 2 > SET_BYTES
        listed = np.repeat(~dense, size)
        lists.append(at[listed])
        bits = np.zeros((int(dense.sum()), CHUNK), "u1")
        bits[np.repeat(np.arange(len(bits)), size[dense]), at[~listed]] = 1
        sets.append(np.packbits(bits, axis=1))
        planes.append((owner, np.full(len(owner), bit), size))
        bit += 1
    columns = [np.concatenate(c) if planes else np.zeros(0) for c in (zip(*planes) if planes else ([], [], []))]
    return {
        "keys": own, "docs": docs, "owner": columns[0].astype("<u4").tobytes(), "bit": columns[1].astype("u1").tobytes(), "size": columns[2].astype("<u2").tobytes(),
        "lists": b"".join(x.tobytes() for x in lists), "sets": b"".join(x.tobytes() for x in sets),
    }


def returned(row, score: np.ndarray, documents: int) -> np.ndarray:
    """Per document the sum over its links of their pair's ``score``."""
    owner, bit, size = (np.frombuffer(row[c], kind) for c, kind in (("owner", "<u4"), ("bit", "u1"), ("size", "<u2")))
    worth = score[owner] << bit
    dense = size.astype("int64") * 2 > SET_BYTES
    total = np.zeros(CHUNK, "int64")
    np.add.at(total, np.frombuffer(row["lists"], "<u2"), np.repeat(worth[~dense], size[~dense]))
    sets, own = np.frombuffer(row["sets"], "u1").reshape(-1, SET_BYTES), worth[dense]
    for lo in range(0, len(sets), 256):
        total += own[lo : lo + 256] @ np.unpackbits(sets[lo : lo + 256], axis=1).astype("int64")
    return total[:documents]


def chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """CHUNKS: the documents of every chunk, aligned, and its postings. A chunk
    is numbered by its task and its place there, and holds rows of one task."""
    schema = pa.schema([
        ("chunk", pa.int64()), ("doc_id", pa.list_(pa.string())), *[(c, pa.list_(pa.int64())) for c in DOCS], ("groups", pa.list_(pa.string())),
        ("keys", pa.list_(pa.int64())), ("docs", pa.list_(pa.int32())), *[(c, pa.binary()) for c in ("owner", "bit", "size", "lists", "sets")],
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner, number = Aligner(sides(path_a, path_b)), TaskContext.get().partitionId() << 32
        ids: List[Optional[str]] = []
        counts: List[List[int]] = []
        groups: List[str] = []
        links: List[np.ndarray] = []

        def row() -> pa.RecordBatch:
            owners = np.repeat(np.arange(len(links)), [len(x) for x in links])
            made = postings(np.concatenate(links), owners)
            columns = {"chunk": number, "doc_id": ids, **{c: [x[k] for x in counts] for k, c in enumerate(DOCS)}, "groups": groups, **made}
            return pa.RecordBatch.from_arrays([pa.array([columns[f.name]], f.type) for f in schema], schema=schema)

        waiting = 0
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for doc_id, found in zip(batch.column(0), aligner.texts(texts)):
                ids.append(doc_id.as_py())
                counts.append(found[2] if found else [0, 0, 0, 0])
                groups.append(found[0] if found else "")
                links.append(found[1] if found else np.zeros(0, "int64"))
                waiting += len(links[-1])
                if len(ids) == CHUNK or waiting >= LINKS:
                    yield row()
                    ids, counts, groups, links, waiting = [], [], [], [], 0
                    number += 1
        if ids:
            yield row()

    # the id travels as text, null or not
    return docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(run, CHUNKS)


def pair_counts(made: DataFrame) -> DataFrame:
    """chunk, key, docs: the share of each chunk in a pair's document count."""
    return made.select("chunk", F.explode(F.arrays_zip("keys", "docs")).alias("p")).select("chunk", F.col("p.keys").alias("key"), F.col("p.docs").cast("long").alias("docs"))


def pair_scores(shares: DataFrame) -> DataFrame:
    """key, n (documents that hold the pair linked), best (1 if that is its A
    id's highest, else 0)."""
    counts = stage(shares.groupBy("key").agg(F.sum("docs").alias("n")), "pair-counts")
    a = F.floor(F.col("key") / SPAN)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))  # a row for each A id at most
    return counts.withColumn("a", a).join(highest, "a").select("key", "n", (F.col("n") == F.col("highest")).cast("long").alias("best"))


RESULT = "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def scored(chunk: pd.DataFrame, scores: pd.DataFrame) -> pd.DataFrame:
    """One chunk's documents with the scores that its postings return."""
    row = chunk.iloc[0]
    keys, n = np.asarray(row["keys"], "int64"), len(row["doc_id"])
    order = np.argsort(scores["key"].to_numpy())
    if not np.array_equal(scores["key"].to_numpy()[order], keys):
        raise ValueError("scores are not those of the chunk's pairs")
    out = {c: np.asarray(row[c], "int64") for c in DOCS}
    out["n_best"] = returned(row, scores["best"].to_numpy("int64")[order], n)
    out["count_sum"] = returned(row, scores["n"].to_numpy("int64")[order], n)
    return pd.DataFrame({"doc_id": list(row["doc_id"]), **out, "groups_sha256": list(row["groups"])})[[c.split()[0] for c in RESULT.split(", ")]]


def align_documents(docs: DataFrame, path_a: Optional[str] = None, path_b: Optional[str] = None) -> DataFrame:
    """``docs`` (doc_id, text) as RESULT, one row per input row.

    A: byte-level BPE ranks, over space + text; B: a sentencepiece model, which
    adds the space; special tokens in texts are plain text. Texts that are null,
    empty, or not spelled by both sides (a text with U+2581) have zeros and ''. Every
    row is a document of its own, repeated or null ids included; an empty table stays
    empty; other columns are left out. Texts are not shuffled: what moves is the
    postings by chunk, and a number for each pair of a chunk. Memory: an Arrow batch
    of texts, LINKS links or those of one longer text, and one chunk's postings."""
    made = stage(chunks(docs, path_a or default_path("byte_bpe_50k.tiktoken"), path_b or default_path("piece_bpe_32k.model")), "pair-bitmaps")
    shares = pair_counts(made)
    scores = shares.select(F.col("chunk").alias("of"), "key").join(pair_scores(shares), "key").select("of", "key", "n", "best")
    done = made.groupBy("chunk").cogroup(scores.groupBy("of")).applyInPandas(scored, RESULT)
    return done.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op11_alignment(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``; edge cases as in ``align_documents``."""
    return align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
