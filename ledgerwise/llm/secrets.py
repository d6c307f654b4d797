"""Secret scan: fixed patterns, and the token-efficiency test.

The patterns find assignments, access keys and long hex runs. The method adds
random strings: a run of key characters is encoded with a tiktoken vocabulary,
and few characters per token mean that it is not made of words. Only fixed
shapes are excluded first (hex of a digest's length, UUIDs, numbers, dates).
Words joined to a secret raise the ratio of the whole run, so the parts between
its signs are scored too, and every stretch of parts that is low by itself is a
span of its own.
"""

from __future__ import annotations

import re
from typing import Iterator, List, Optional, Tuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwise.llm.common import text_batches
from ledgerwise.llm.vocab import default_path, encoding

KINDS = ("assign", "access", "hex", "random")
MIN_RUN = 20
#: Characters per token below which a run counts as random. Base-62 text needs
#: about one token for 1.5 characters, words one for 2.5 and more.
MAX_RATIO = 2.0
#: The same for letters of one case without a break, which also agglutinating
#: and compounding languages write, and for short lower-case words in a chain
#: (slugs of languages that the vocabulary hardly knows).
LETTERS_RATIO = 1.95
WORD_RATIO = 1.6
#: Runs are encoded in pieces of this length, so a huge run stays linear.
PIECE = 256

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
UUID = re.compile(r"(?<![A-Za-z0-9])[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}(?![A-Za-z0-9])")
NUMBERS = re.compile(r"[0-9+/_=-]+")  # numbers, dates, rulers
#: Words joined by signs, or a word and a number: judged by their parts alone,
#: because the signs would count as short tokens.
CHAIN = re.compile(r"[A-Za-z]+(?:[/_=+-]+(?:[A-Za-z]+|[0-9]{1,4}))*|[A-Za-z]*[0-9]{1,6}")
PART = re.compile(r"[A-Za-z0-9]+")
NUMBERED = re.compile(r"([A-Za-z]+)[0-9]{0,6}")
HEX_RUN = re.compile(r"[0-9a-f]+|[0-9A-F]+")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

Span = Tuple[int, str, int]


def base_spans(text: str) -> List[Span]:
    """(start, kind, end) of the fixed patterns, code points, leftmost and
    non-overlapping per kind. Hex and access runs are maximal, so asking for
    the minimum length in the pattern drops exactly the failing matches."""
    found: List[Span] = []
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]
    return found


def is_digest(bare: str) -> bool:
    return len(bare) in DIGEST_LENGTHS and HEX_RUN.fullmatch(bare) is not None


def known(run: str) -> bool:
    """Whether the run is a digest or an identifier of a fixed shape."""
    bare = run.strip("=-_/+")
    return is_digest(bare) or UUID.fullmatch(bare) is not None or NUMBERS.fullmatch(run) is not None


def n_tokens(run: str, enc) -> int:
    return sum(len(enc.encode_ordinary(run[i : i + PIECE])) for i in range(0, len(run), PIECE))


def chars_per_token(run: str, enc) -> float:
    return len(run) / max(1, n_tokens(run, enc))


def part_score(part: str, enc, max_ratio: float) -> float:
    """Above 0 if the part has fewer characters per token than its kind of word.
    Numbers and single letters tell nothing."""
    numbered = NUMBERED.fullmatch(part)
    word = numbered.group(1) if numbered else part
    if len(word) == 1 or word.isdigit():
        return 0.0
    ratio = max_ratio
    if len(word) < MIN_RUN and word[1:].isalpha() and word[1:].islower():
        ratio = min(ratio, WORD_RATIO)
    elif word.isalpha() and (word[1:].islower() or word.isupper()):
        ratio = min(ratio, LETTERS_RATIO)
    return ratio * n_tokens(word, enc) - len(word)


def maximal_stretches(scores: List[float]) -> List[Tuple[int, int]]:
    """All maximal-scoring stretches (first, end), by Ruzzo and Tompa: linear,
    and none hides another."""
    found: List[Tuple[float, float, int, int, int]] = []  # sum before, sum after, first, end, last with a smaller sum before
    total = 0.0
    for i, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        first, j = i, len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= before:
                j = found[j][4]
            if j < 0 or found[j][1] >= total:
                break
            before, first, link = found[j][0], found[j][2], found[j][4]
            del found[j:]
            j = link
        found.append((before, total, first, i + 1, j))
    return [(f, e) for _, _, f, e, _ in found]


def random_stretches(run: str, enc, max_ratio: float) -> List[Tuple[int, int]]:
    """(start, end) in the run: all of it, or its parts that are random."""
    if known(run):
        return []
    if not CHAIN.fullmatch(run.strip("=-_/+")) and chars_per_token(run, enc) < max_ratio:
        return [(0, len(run))]
    parts = list(PART.finditer(run))
    fixed = [m.span() for m in UUID.finditer(run)]
    never = -max_ratio * len(run) - 1  # more than all other parts make up for
    scores, at = [], 0
    for p in parts:
        while at < len(fixed) and fixed[at][1] <= p.start():
            at += 1
        barred = is_digest(p.group()) or (at < len(fixed) and fixed[at][0] <= p.start())
        scores.append(never if barred else part_score(p.group(), enc, max_ratio))
    ranges = [(parts[f].start(), parts[e - 1].end()) for f, e in maximal_stretches(scores)]
    return [(s, e) for s, e in ranges if e - s >= MIN_RUN]


def random_spans(text: str, base: List[Span], enc, max_ratio: float = MAX_RATIO) -> List[Span]:
    found: List[Span] = []
    taken = sorted((s, e) for s, _, e in base)
    for m in RUN.finditer(text):
        # what base spans hold is found already; the rest of the run is looked at by itself
        at, free = m.start(), []
        for s, e in taken:
            if s < m.end() and m.start() < e:
                free.append((at, s))
                at = max(at, e)
        for lo, hi in [*free, (at, m.end())]:
            if hi - lo >= MIN_RUN:
                found += [(lo + s, "random", lo + e) for s, e in random_stretches(text[lo:hi], enc, max_ratio)]
    return found


def all_spans(text: str, enc, max_ratio: float = MAX_RATIO) -> List[str]:
    base = base_spans(text)
    spans = base + random_spans(text, base, enc, max_ratio)
    spans.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return [f"{k}:{s}:{e}" for s, k, e in spans]


def secrets_udf(vocab: str, max_ratio: float):
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(vocab)
        for texts in batches:
            yield pd.Series([all_spans(t, enc, max_ratio) if t else [] for t in texts], dtype=object)

    return scan


def find_secrets(docs: DataFrame, text: str = "text", vocab: Optional[str] = None, max_ratio: float = MAX_RATIO) -> DataFrame:
    """``docs`` plus ``secrets``: array<struct<kind, start, end>> by start, then
    kind, in code points with the end exclusive. Null or empty text has none.
    A column named secrets is replaced; all others stay."""
    raw = secrets_udf(vocab or default_path("byte_bpe_50k.tiktoken"), max_ratio)(F.col(text))

    def span(s: Column) -> Column:
        part = F.split(s, ":")
        return F.struct(part[0].alias("kind"), part[1].cast("long").alias("start"), part[2].cast("long").alias("end"))

    return text_batches(docs).withColumn("secrets", raw).withColumn("secrets", F.transform("secrets", span))


def _joined(spans: Column) -> Column:
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, text), ",")


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs).withColumn("base", F.filter("secrets", lambda s: s["kind"] != "random"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
        count("random").alias("n_random"),
    )
