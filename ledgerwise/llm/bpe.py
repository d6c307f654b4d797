"""Byte-level BPE by prefix dynamic programming.

Every prefix of a pattern match has exactly one encoding, and that encoding
ends in exactly one token. The token is found from the shorter prefixes: among
the tokens that end at a byte (an Aho-Corasick automaton lists them), it is the
one that the last token of the prefix before it can stand next to. Two tokens
can stand side by side if merging their joined bytes never crosses the seam.
The table of last tokens is the whole encoding state:

* the ids are read off backwards, from the last byte to the first;
* appended bytes only add entries, and the result is exact;
* after an edit, entries are recomputed from the edit on until a stretch as
  long as the longest token agrees with the old table; the rest is kept.

Texts are split into matches of the public pattern, and each match has a table
of its own. Words met again come from a bounded cache.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from functools import lru_cache
from typing import Dict, Iterator, List, Optional, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.vocab import default_path, ranks

CACHED_WORDS = 600_000
CACHED_MATCHES = 300_000
CACHED_LENGTH = 64
CACHED_SEAMS = 1_000_000
#: A match of the pattern is settled if so many characters follow its end: the
#: pattern looks at two characters behind an apostrophe and one behind others.
LOOK_AHEAD = 3
# A single space between other characters starts a match of its own, so texts
# are cut there and the stretches remembered.
WORD_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Stands for the token before the first one of a match; every token can follow.
START = -1


class Vocabulary:
    """Ranks, and what they imply: the merge that makes each token, and which
    tokens can stand side by side."""

    def __init__(self, ranks: Dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of: Dict[int, bytes] = {i: b for b, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.decoding = np.empty(max(self.bytes_of) + 1, dtype=object)
        for i, token in self.bytes_of.items():
            self.decoding[i] = token
        self.halves: Dict[int, Tuple[int, int]] = {}
        # by right token: the left ones asked for, and the answers
        self.lefts: Dict[int, Dict[int, bool]] = {i: {START: True} for i in self.bytes_of}
        self.seams = 0
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            if len(token) > 1:
                last = self._last_merge(token)
                if last is None:  # merging its bytes never ends in it: only a whole match can be this token
                    continue
                self.halves[i] = last
            self.automaton.add_word(token.decode("latin-1"), (i, len(token), self.lefts[i]))
        self.automaton.make_automaton()

    def _last_merge(self, token: bytes) -> Optional[Tuple[int, int]]:
        """The two tokens whose merge completes ``token``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            at = min(range(len(parts) - 1), key=lambda k: self.ranks.get(parts[k] + parts[k + 1], 1 << 40))
            joined = parts[at] + parts[at + 1]
            if joined not in self.ranks:
                return None
            parts[at : at + 2] = [joined]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def beside(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens ends in these two.

        Time is undone, the later merge first. At each step two tokens face each
        other at the seam, until one of them is used up by a merge on its own
        side; a merge across the seam before that would have come first. Of
        equal merges the leftmost comes first."""
        known = self.lefts[right].get(left)
        if known is None:
            if self.seams >= CACHED_SEAMS:
                for lefts in self.lefts.values():
                    lefts.clear()
                    lefts[START] = True
                self.seams = 0
            known = self.lefts[right][left] = self._beside(left, right)
            self.seams += 1
        return known

    def _beside(self, left: int, right: int) -> bool:
        until = 1 << 40
        while True:
            across = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if across is not None and across < until:
                return False
            made_left, made_right = (t if t in self.halves else -1 for t in (left, right))
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                until, left = left, self.halves[left][1]
            else:
                until, right = right + 1, self.halves[right][0]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(ranks(path), public_tokenizers.PATTERN)


class PrefixTable:
    """The last token of every prefix of one pattern match."""

    def __init__(self, vocab: Vocabulary, data: bytes = b""):
        self.vocab, self.data, self.last = vocab, b"", array("i")
        self.append(data)

    def append(self, more: bytes) -> None:
        start = len(self.data)
        self.data += more
        self.last.frombytes(b"\xff" * (4 * len(more)))  # -1 each
        self._fill(start)

    def _fill(self, start: int, old: Optional["PrefixTable"] = None, settled: int = 0) -> None:
        """Entries from ``start`` on. With ``old``, the table before an edit that
        ended at ``settled``: stops where the tables have met again."""
        last, beside, same = self.last, self.vocab.beside, 0
        shift = len(self.data) - len(old.data) if old else 0
        base = max(0, start - self.vocab.longest)
        done = start - 1
        for end, (token, size, _) in self.vocab.automaton.iter(self.data[base:].decode("latin-1")):
            end += base
            if end < start or last[end] >= 0:
                continue
            before = end - size
            if before < 0 or beside(last[before], token):
                last[end] = token
                if old is not None and end >= settled:
                    same = same + 1 if done == end - 1 and old.last[end - shift] == token else int(old.last[end - shift] == token)
                    if same > self.vocab.longest:
                        last[end + 1 :] = old.last[end + 1 - shift :]
                        return
                done = end

    def become(self, data: bytes) -> None:
        """The table of ``data``, keeping all that it shares with this one."""
        old = PrefixTable(self.vocab)
        old.data, old.last = self.data, self.last
        limit = min(len(old.data), len(data))
        a, b = np.frombuffer(old.data, "u1"), np.frombuffer(data, "u1")
        head = _common(a[:limit], b[:limit])
        tail = _common(a[::-1][: limit - head], b[::-1][: limit - head])
        self.data, self.last = data, old.last[:head]
        self.last.frombytes(b"\xff" * (4 * (len(data) - head)))
        self._fill(head, old, len(data) - tail)

    def ids(self) -> List[int]:
        out, end, bytes_of = [], len(self.data), self.vocab.bytes_of
        while end > 0:
            out.append(self.last[end - 1])
            end -= len(bytes_of[out[-1]])
        out.reverse()
        return out


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common start of two arrays of one length."""
    differ = np.flatnonzero(a != b)
    return int(differ[0]) if len(differ) else len(a)


class Recent:
    """A bounded cache by text: of its two halves the older one goes when the
    newer is full, and what is met again moves to the newer. Long keys are not
    kept."""

    def __init__(self, most: int = CACHED_MATCHES):
        self.newer, self.older, self.half = {}, {}, most // 2

    def get(self, key: str):
        found = self.newer.get(key)
        if found is None:
            found = self.older.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value) -> None:
        if len(key) <= CACHED_LENGTH:
            if len(self.newer) >= self.half:
                self.newer, self.older = {}, self.newer
            self.newer[key] = value


class Encoder:
    """Whole texts to ids; words and matches met again come from a cache.
    ``words`` holds what follows a space, without that space: it neither begins
    nor ends with white space."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.words, self.matches = vocab, Recent(CACHED_WORDS), Recent(CACHED_MATCHES)

    def piece(self, match: str) -> List[int]:
        """The ids of one match; the table of a short one is not kept."""
        vocab = self.vocab
        data = match.encode("utf-8")
        whole = vocab.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > CACHED_LENGTH:
            return PrefixTable(vocab, data).ids()
        last: List[Optional[int]] = [None] * len(data)
        last.append(START)  # before the first byte: index -1
        for end, (token, size, lefts) in vocab.automaton.iter(data.decode("latin-1")):
            if last[end] is None:
                fits = lefts.get(last[end - size])
                if fits or fits is None and vocab.beside(last[end - size], token):
                    last[end] = token
        out, end, bytes_of = [], len(data), vocab.bytes_of
        while end > 0:
            token = last[end - 1]
            out.append(token)
            end -= len(bytes_of[token])
        return out[::-1]

    def match(self, match: str) -> bytes:
        if match[0] == " " and match[1:2].strip():
            cache, key = self.words, match[1:]
        else:
            cache, key = self.matches, match
        found = cache.get(key)
        if found is None:
            found = array("I", self.piece(match)).tobytes()
            cache.put(key, found)
        return found

    def encoded(self, word: str) -> bytes:
        return b"".join(map(self.match, self.vocab.pattern.findall(word)))

    def after_space(self, word: str) -> bytes:
        """The ids of a space and ``word``."""
        if word.isascii() and word.isalpha():  # one match
            return self.match(" " + word)
        found = self.words.get(word)
        if found is None:
            found = self.encoded(" " + word)
            if not word[-1].isspace():
                self.words.put(word, found)
        return found

    def _cut(self, cut: List[str], sure: bool) -> Optional[List[bytes]]:
        """The ids of each part of a text that is cut at single spaces. None if
        a space it is cut at touches other white space; ``sure``: none does."""
        own, end = list(map(self.words.newer.get, cut)), len(cut) - 1
        own[0] = None  # no space before it
        for k in [k for k, found in enumerate(own) if found is None]:
            word = cut[k]
            if end and not sure and (not word or k and word[0].isspace() or k < end and word[-1].isspace()):
                return None
            own[k] = self.after_space(word) if k else self.encoded(word)
        return own

    def ids(self, text: str) -> np.ndarray:
        own = self._cut(text.split(" "), False)
        if own is None:
            own = self._cut(WORD_CUT.split(text), True)
        return np.frombuffer(b"".join(own), dtype="<u4")

    def decoded(self, ids: np.ndarray) -> bytes:
        return b"".join(self.vocab.decoding[ids.astype("int64")].tolist())


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One a Python worker, so what it knows outlives a task."""
    return Encoder(vocabulary(path))


class EncodedText:
    """A text under edit: the matches of the pattern, each with its ids (and its
    table once it has been edited)."""

    def __init__(self, encoder: Encoder, text: str = "", ids: Optional[np.ndarray] = None):
        """``ids``: the known ids of ``text``, so that nothing is encoded."""
        self.encoder, self.text = encoder, text
        self.starts: List[int] = []
        self.pieces: List[List[int]] = []
        self.tables: Dict[int, PrefixTable] = {}  # by start, of edited matches
        known = ids.tolist() if ids is not None else None
        at = 0
        for m in encoder.vocab.pattern.finditer(text):
            if known is None:
                own = encoder.piece(m.group())
            else:
                need, first = len(m.group().encode("utf-8")), at
                while need > 0:
                    need -= len(encoder.vocab.bytes_of[known[at]])
                    at += 1
                if need:
                    raise ValueError("the ids are not those of the text")
                own = known[first:at]
            self.starts.append(m.start())
            self.pieces.append(own)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, stop: int, added: str) -> None:
        """Replace the code points ``start`` to ``stop`` (exclusive)."""
        start = min(max(start, 0), len(self.text))
        stop = min(max(stop, start), len(self.text))
        text = self.text[:start] + added + self.text[stop:]
        shift = len(text) - len(self.text)
        ends = self.starts[1:] + [len(self.text)]
        keep = int(np.searchsorted(np.array(ends[: len(self.starts)], dtype="int64"), start - LOOK_AHEAD, side="right"))
        old = {s + shift: k for k, s in enumerate(self.starts) if s >= stop}
        starts, pieces, tables = self.starts[:keep], self.pieces[:keep], {s: t for s, t in self.tables.items() if keep and s < ends[keep - 1]}
        at = self.starts[keep] if keep < len(self.starts) else (ends[keep - 1] if keep else 0)
        first = keep  # the old match that stands where the new ones begin
        while at < len(text):
            if at in old:
                k = old[at]
                starts += [s + shift for s in self.starts[k:]]
                pieces += self.pieces[k:]
                tables.update({s + shift: t for s, t in self.tables.items() if s >= self.starts[k]})
                break
            match = self.encoder.vocab.pattern.match(text, at).group()
            data = match.encode("utf-8")
            table = self.tables.get(at) if first < len(self.starts) and at == self.starts[first] else None
            if table is None and first < len(self.starts) and at == self.starts[first] and len(data) > CACHED_LENGTH:
                table = PrefixTable(self.encoder.vocab, self.text[at : ends[first]].encode("utf-8"))
            if table is not None:
                table.become(data)
                tables[at] = table
                whole = self.encoder.vocab.ranks.get(data)
                pieces.append(table.ids() if whole is None else [whole])
            else:
                pieces.append(self.encoder.piece(match))
            starts.append(at)
            at += len(match)
            first += 1
        self.text, self.starts, self.pieces, self.tables = text, starts, pieces, tables

    def ids(self) -> np.ndarray:
        return np.array([i for p in self.pieces for i in p], dtype="<u4")


# --- on Spark ----------------------------------------------------------------


def _digest(data) -> str:
    return hashlib.sha256(data).hexdigest()


def encode(docs: DataFrame, vocab: Optional[str] = None, with_ids: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, n_tokens, ids_sha256, decoded_sha256,
    and the ``ids`` (array<int>) when asked for.

    One row per input row. A null text counts as empty and has no token; a null
    doc_id stays null, repeated rows come out repeated, an empty table stays
    empty, other columns are left out. A text is one row of one task, held a
    few times over: memory is bounded by an Arrow batch (``maxBytesPerBatch``)
    and the longest text. Nothing is shuffled."""
    path = vocab or default_path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for batch in batches:
            found = [own.ids(t) if t else np.array([], dtype="<u4") for t in batch["text"]]
            out = pd.DataFrame({
                "doc_id": batch["doc_id"],
                "n_tokens": np.array([len(ids) for ids in found], dtype="int64"),
                "ids_sha256": [_digest(ids) for ids in found],
                "decoded_sha256": [_digest(own.decoded(ids)) for ids in found],
            })
            if with_ids:
                out["ids"] = [ids.astype("int32") for ids in found]
            yield out

    # the id travels as text: a null would make numbers floats in pandas
    own = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    kind = docs.schema["doc_id"].dataType
    out = own.mapInPandas(run, "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def decode(encoded: DataFrame, vocab: Optional[str] = None) -> DataFrame:
    """``encoded`` plus ``decoded`` (binary): the bytes of ``ids`` (array<int>; null: none)."""
    path = vocab or default_path("byte_bpe_50k.tiktoken")

    @F.pandas_udf("binary")
    def decoded(ids: pd.Series) -> pd.Series:
        known = encoder(path)
        return ids.map(lambda own: b"" if own is None else known.decoded(np.asarray(own)))

    return encoded.withColumn("decoded", decoded("ids"))


def reencode(encoded: DataFrame, edits: DataFrame, vocab: Optional[str] = None) -> DataFrame:
    """doc_id and ``ids`` after ``edits``, for the documents that have some.

    ``encoded``: doc_id (unique), ids (array<int>). ``edits``: doc_id, seq,
    start, stop, added; an edit replaces the code points start to stop of the
    text as the edits before it (by seq, then by the other columns) left it; places
    beyond the text are moved to its end, a null ``added`` is empty. Only matches
    around an edit are encoded again."""
    path = vocab or default_path("byte_bpe_50k.tiktoken")

    @F.pandas_udf("array<int>")
    def edited(ids: pd.Series, changes: pd.Series) -> pd.Series:
        known = encoder(path)

        def one(own, steps) -> np.ndarray:
            own = np.asarray(own if own is not None else [], dtype="<u4")
            text = EncodedText(known, known.decoded(own).decode("utf-8"), own)
            for step in steps:
                text.edit(step["start"], step["stop"], step["added"] or "")
            return text.ids().astype("int32")

        return pd.Series([one(a, b) for a, b in zip(ids, changes)])

    steps = edits.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("seq", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "added"))).alias("changes")
    )
    return encoded.select("doc_id", "ids").join(steps, "doc_id").select("doc_id", edited("ids", "changes").alias("ids"))


def op13_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded; edge cases as in ``encode``."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
