"""Language identification with a linear-chain conditional random field.

Every word of a text gets a label. A word's score for a language is the sum of
learned weights of its features: the letter n-grams of orders 2 to 4, where
those that touch the word's edge are its affixes; the word itself; and the
languages whose lexicon of frequent words holds it. Learned transition weights
tie neighbouring words, so labels switch where the text switches. Posteriors
come from the forward-backward algorithm over the whole text; a document's
language has the largest mean posterior.

Weights are fitted by maximum likelihood on spliced texts: segments of
labelled documents of several languages put one after another.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from typing import Dict, List, Sequence, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwise.llm.common import fold, give_back, text_batches

#: Bounds of the training sample: documents per language, segments of a
#: document and characters of a segment.
DOCS_PER_LANGUAGE = 400
SEGMENTS = 2
SEGMENT_CHARS = 500
#: Feature table and lexicon sizes.
FEATURES = 1 << 16
LEXICON_WORDS = 300
SEQUENCE_WORDS = 48
SEQUENCES_PER_LANGUAGE = 300
STEPS = 80
HELD_OUT = 2
UNKNOWN = "und"
#: Characters handled at once, and words of a forward-backward chunk.
BLOCK_CHARS = 1 << 18
CHUNK = 32

M1, M2, M3, M4 = (np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F))


@dataclass(frozen=True)
class Model:
    languages: Tuple[str, ...]
    weights: np.ndarray  # FEATURES x K, n-grams and words
    lexicon: Tuple[np.ndarray, np.ndarray]  # word hashes, sorted; K 0/1 columns each
    lexicon_weights: np.ndarray  # K x K
    transitions: np.ndarray  # K x K
    start: np.ndarray  # K


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)], dtype=bool)


def lower(text: str) -> str:
    """Lower case, code point by code point, so that places stay the same."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, 0 for whatever is no letter."""
    c = np.frombuffer(lower(text).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(_letters()[c], c, np.uint32(0))


def _slot(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint32(15))
    h = h * M2
    return (h ^ (h >> np.uint32(13))) & np.uint32(FEATURES - 1)


@dataclass
class Words:
    """Words of a code array: first and end places, n-gram slots per letter
    (3 x letters), each word's first letter, the words' hashes and slots."""

    first: np.ndarray
    end: np.ndarray
    grams: np.ndarray
    letter_at: np.ndarray
    hashes: np.ndarray


def words_of(c: np.ndarray) -> Words:
    """``c`` must begin with 0 and end with three 0."""
    is_letter = c != 0
    at = np.flatnonzero(is_letter)
    first = np.flatnonzero(is_letter & ~np.concatenate(([False], is_letter[:-1])))
    end = np.flatnonzero(~is_letter & np.concatenate(([False], is_letter[:-1])))
    if not len(at):
        empty = np.zeros(0, dtype=np.int64)
        return Words(empty, empty, np.zeros((3, 0), np.uint32), empty, np.zeros(0, np.uint32))
    before, here, after, second = c[at - 1], c[at], c[at + 1], c[at + 2]
    two = before * M1 + here * M3
    three = two * M2 + after * M4 + np.uint32(3)
    four = three * M1 + np.where(after == 0, np.uint32(0), second) * M2 + np.uint32(4)
    letter_at = np.searchsorted(at, first)
    place = (np.arange(len(at)) - np.repeat(letter_at, end - first)).astype(np.uint32)
    mixed = (here * M1 + place * M3) * M2
    mixed ^= mixed >> np.uint32(15)
    hashes = np.add.reduceat(mixed * M4, letter_at, dtype=np.uint32)
    return Words(first, end, np.stack([_slot(two), _slot(three), _slot(four)]), letter_at, hashes)


def emissions(w: Words, m: Model) -> np.ndarray:
    if not len(w.first):
        return np.zeros((0, len(m.languages)))
    g = m.weights[w.grams[0]]
    g += m.weights[w.grams[1]]
    g += m.weights[w.grams[2]]
    e = np.add.reduceat(g, w.letter_at, axis=0).astype("float64")
    e += m.weights[_slot(w.hashes)]
    return e + lexicon_rows(w.hashes, m.lexicon) @ m.lexicon_weights


def lexicon_rows(hashes: np.ndarray, lexicon: Tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, columns = lexicon
    if not len(known):
        return np.zeros((len(hashes), columns.shape[1]))
    i = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return columns[i] * (known[i] == hashes)[:, None]


def posteriors(em: np.ndarray, lengths: Sequence[int], transitions: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Label posteriors of every word; ``em`` holds the texts' words one after
    another. Exact forward-backward in two levels: matrix products of chunks of
    words, all chunks at a time, tie the chunks of a text together; then every
    chunk runs with its own incoming and outgoing vectors."""
    n, k = em.shape
    lengths = np.asarray(lengths, dtype=np.int64)
    if n == 0:
        return np.zeros((0, k))
    a = np.exp(transitions - transitions.max())
    eye = np.eye(k)
    s0 = np.exp(start - start.max())
    e_all = np.exp(em - em.max(axis=1, keepdims=True))

    # chunks of each text in text order; longest texts first, so active texts are a prefix
    text_first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    per_text = -(-lengths[order] // CHUNK)
    chunk0 = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    nc = int(per_text.sum())
    owner = np.repeat(np.arange(len(order)), per_text)
    ordinal = np.arange(nc) - chunk0[owner]
    begin = text_first[order][owner] + ordinal * CHUNK
    size = np.minimum(CHUNK, lengths[order][owner] - ordinal * CHUNK)
    # stored longest chunk first, so active chunks are a prefix too
    by_size = np.argsort(-size, kind="stable")
    rank = np.empty(nc, dtype=np.int64)
    rank[by_size] = np.arange(nc)
    begin, size, is_first = begin[by_size], size[by_size], (ordinal == 0)[by_size]
    active = [int(np.searchsorted(-size, -t, side="left")) for t in range(CHUNK)]  # chunks with more than t words

    step = [e_all[begin[:c] + t] for t, c in enumerate(active) if c]
    product = np.where(is_first[:, None, None], eye, a) * step[0][:, None, :]
    for t in range(1, len(step)):
        c = active[t]
        p = (product[:c].reshape(-1, k) @ a).reshape(c, k, k) * step[t][:, None, :]
        product[:c] = p / p.max(axis=(1, 2), keepdims=True)

    incoming, outgoing = np.empty((nc, k)), np.empty((nc, k))
    most = int(per_text.max())
    texts = [int(np.searchsorted(-per_text, -j, side="left")) for j in range(most)]
    v = np.tile(s0, (len(order), 1))
    for j in range(most):
        at = rank[chunk0[: texts[j]] + j]
        incoming[at] = v[: texts[j]]
        nxt = np.matmul(v[: texts[j], None, :], product[at])[:, 0, :]
        v[: texts[j]] = nxt / nxt.max(axis=1, keepdims=True)
    v = np.ones((len(order), k))
    for j in range(most - 1, -1, -1):
        at = rank[chunk0[: texts[j]] + j]
        outgoing[at] = v[: texts[j]]
        nxt = np.matmul(product[at], v[: texts[j], :, None])[:, :, 0]
        v[: texts[j]] = nxt / nxt.max(axis=1, keepdims=True)

    post = np.empty_like(em)
    forward: List[np.ndarray] = []
    x = incoming
    for t in range(len(step)):
        c = active[t]
        x = x[:c]
        moved = np.where(is_first[:, None], x, x @ a) if t == 0 else x @ a
        x = moved * step[t]
        x = x / x.max(axis=1, keepdims=True)
        forward.append(x)
    y = outgoing
    for t in range(len(step) - 1, -1, -1):
        c = active[t]
        p = forward[t] * y[:c]
        post[begin[:c] + t] = p / p.sum(axis=1, keepdims=True)
        if t:
            nxt = (step[t] * y[:c]) @ a.T
            y[:c] = nxt / nxt.max(axis=1, keepdims=True)
    return post


def label_texts(texts: Sequence[str], m: Model):
    """Yields (index, words, posteriors) per text with a word, handling about
    BLOCK_CHARS characters at a time; a longer text is scored in blocks that
    end between words and tied together over its whole length."""
    group: List[int] = []
    size = 0

    def flush(group: List[int]):
        parts = [codes(texts[i]) for i in group]
        pad = np.zeros(3, dtype=np.uint32)
        pieces, offset, bounds = [pad], 3, []
        for p in parts:
            bounds.append(offset)
            pieces += [p, pad]
            offset += len(p) + 3
        w = words_of(np.concatenate(pieces))
        cuts = np.searchsorted(w.first, np.array(bounds + [offset]))
        lengths = np.diff(cuts)
        post = posteriors(emissions(w, m), lengths, m.transitions, m.start)
        for i, lo, hi, b in zip(group, cuts[:-1], cuts[1:], bounds):
            if hi > lo:
                yield i, w.first[lo:hi] - b, w.end[lo:hi] - b, post[lo:hi]

    for i, t in enumerate(texts):
        if not t:
            continue
        if len(t) > BLOCK_CHARS:
            yield from _long(i, t, m)
            continue
        if group and size + len(t) > BLOCK_CHARS:
            yield from flush(group)
            group, size = [], 0
        group.append(i)
        size += len(t)
    if group:
        yield from flush(group)


def _long(i: int, text: str, m: Model):
    c = codes(text)
    gaps = np.flatnonzero(c == 0)
    first, end, em = [], [], []
    lo = 0
    while lo < len(c):
        hi = len(c)
        if hi - lo > BLOCK_CHARS:
            g = np.searchsorted(gaps, lo + BLOCK_CHARS)
            hi = int(gaps[g]) + 1 if g < len(gaps) else len(c)
        w = words_of(np.concatenate([np.zeros(1, np.uint32), c[lo:hi], np.zeros(3, np.uint32)]))
        first.append(w.first + lo - 1)
        end.append(w.end + lo - 1)
        em.append(emissions(w, m))
        lo = hi
    em_all = np.concatenate(em)
    if len(em_all):
        yield i, np.concatenate(first), np.concatenate(end), posteriors(em_all, [len(em_all)], m.transitions, m.start)


# --- fitting -----------------------------------------------------------------


def training_segments(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> List[Tuple[str, str]]:
    """(language, segment) of labelled documents outside the held-out fold:
    documents drawn by hash per language, segments from hashed places of the
    whole text. Bounded by languages x documents x SEGMENTS x SEGMENT_CHARS: rows
    that share an id and a label are one document (the least segments), and no more
    than the documents asked for leave a task. Rows without an id count by their text."""
    own = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT))
    hashed = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit("language"))).otherwise(F.xxhash64("doc_id", F.lit("language")))
    # documents, not rows: one id may hold most rows of a label
    counts = {r["lang"]: max(r["n"], 1) for r in own.groupBy("lang").agg(F.approx_count_distinct(hashed).alias("n")).collect()}
    if not counts:
        return []
    span = 1 << 30
    # about twice the documents wanted, then exactly as many by the order of the hash
    share = [x for lang, n in sorted(counts.items()) for x in (F.lit(lang), F.lit(int(min(1.0, (2 * docs_per_language + 50) / n) * span)))]
    draw = F.pmod(hashed, F.lit(span))
    picked = own.filter(draw < F.element_at(F.create_map(*share), F.col("lang")))
    place = lambda i: F.pmod(F.xxhash64("doc_id", i), F.greatest(F.char_length("text") - SEGMENT_CHARS, F.lit(1))).cast("int") + 1
    cut = F.transform(F.sequence(F.lit(1), F.lit(SEGMENTS)), lambda i: F.substring(F.col("text"), place(i), F.lit(SEGMENT_CHARS)))
    found = picked.select("lang", "doc_id", draw.alias("draw"), F.array_distinct(cut).alias("cut"))
    found = found.groupBy("lang", "doc_id", "draw").agg(F.min("cut").alias("cut"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    rows = found.withColumn("rank", rank).filter(F.col("rank") <= docs_per_language).drop("rank").collect()
    rows = sorted(rows, key=lambda r: (r["lang"], r["draw"], -1 if r["doc_id"] is None else r["doc_id"], r["cut"]))
    return [(r["lang"], s) for r in rows for s in r["cut"] if s]


def fit_segments(segments: Sequence[Tuple[str, str]], seed: int = 11) -> Model:
    """Maximum likelihood by Adam on spliced sequences of SEQUENCE_WORDS words,
    over the languages that have words."""
    pad = np.zeros(3, np.uint32)
    words: Dict[str, List[Words]] = {}
    for lang, s in segments:
        w = words_of(np.concatenate([pad, codes(s), pad]))
        if len(w.first):
            words.setdefault(lang, []).append(w)
    # a label without a single word tells nothing: the others are learned
    languages = tuple(sorted(words))
    k = len(languages)
    if k < 2:
        return Model(languages, np.zeros((FEATURES, k), np.float32), (np.zeros(0, np.uint32), np.zeros((0, k))), np.zeros((k, k)), np.zeros((k, k)), np.zeros(k))
    pool = [words[lang] for lang in languages]

    lists = []
    for p in pool:
        seen, n = np.unique(np.concatenate([w.hashes for w in p]), return_counts=True)
        lists.append(seen[np.argsort(-n, kind="stable")][:LEXICON_WORDS])
    known = np.unique(np.concatenate(lists))
    columns = np.stack([np.isin(known, x) for x in lists], axis=1).astype("float64")

    rng = np.random.Generator(np.random.PCG64(seed))
    grams, owner, hashes, labels = [], [], [], []
    n_seq = SEQUENCES_PER_LANGUAGE * k
    for q in range(n_seq):
        filled = 0
        label = q % k
        while filled < SEQUENCE_WORDS:
            w = pool[label][rng.integers(len(pool[label]))]
            run = int(min(SEQUENCE_WORDS - filled, len(w.first), rng.integers(4, SEQUENCE_WORDS)))
            at = int(rng.integers(len(w.first) - run + 1))
            stop = w.letter_at[at + run] if at + run < len(w.first) else w.grams.shape[1]
            own = np.repeat(np.arange(run), w.end[at : at + run] - w.first[at : at + run])
            grams.append(w.grams[:, w.letter_at[at] : stop])
            owner.append(own + q * SEQUENCE_WORDS + filled)
            hashes.append(w.hashes[at : at + run])
            labels += [label] * run
            filled += run
            label = int(rng.integers(k))
    grams_all, owner_all = np.concatenate(grams, axis=1), np.concatenate(owner)
    hash_all, y = np.concatenate(hashes), np.array(labels)
    n = len(y)
    onehot = np.eye(k)[y]
    lex = lexicon_rows(hash_all, (known, columns))
    slot = _slot(hash_all)
    index = np.concatenate([grams_all[0], grams_all[1], grams_all[2], slot]).astype(np.int64)
    of_word = np.concatenate([owner_all, owner_all, owner_all, np.arange(n)])
    by_word = np.argsort(of_word, kind="stable")
    index, of_word = index[by_word], of_word[by_word]
    starts = np.searchsorted(of_word, np.arange(n))

    W, L, A, S = np.zeros((FEATURES, k)), np.zeros((k, k)), np.zeros((k, k)), np.zeros(k)
    params = [W, L, A, S]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    y2 = y.reshape(n_seq, SEQUENCE_WORDS)
    seen_pairs = np.zeros((k, k))
    np.add.at(seen_pairs, (y2[:, :-1].ravel(), y2[:, 1:].ravel()), 1)
    for step in range(1, STEPS + 1):
        em = np.add.reduceat(W[index], starts, axis=0) + lex @ L
        post, pairs = _expected(em.reshape(n_seq, SEQUENCE_WORDS, k), A, S)
        delta = (post.reshape(n, k) - onehot) / n_seq
        spread = delta[of_word]
        gw = np.stack([np.bincount(index, spread[:, j], FEATURES) for j in range(k)], axis=1)
        grads = [
            gw + 1e-5 * W,
            lex.T @ delta + 1e-5 * L,
            (pairs - seen_pairs) / n_seq + 1e-4 * A,
            (post[:, 0].sum(axis=0) - np.bincount(y2[:, 0], minlength=k)) / n_seq + 1e-4 * S,
        ]
        for p, g, f, s in zip(params, grads, first, second):
            f *= 0.9
            f += 0.1 * g
            s *= 0.99
            s += 0.01 * g * g
            p -= 0.1 * (f / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    return Model(languages, W.astype(np.float32), (known, columns), L, A, S)


def _expected(em: np.ndarray, transitions: np.ndarray, start: np.ndarray):
    """Posteriors and summed pair expectations of sequences of one length."""
    a, s0 = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    e = np.exp(em - em.max(axis=2, keepdims=True))
    n, length, k = e.shape
    alpha, beta = np.empty_like(e), np.ones_like(e)
    x = s0 * e[:, 0]
    for t in range(length):
        if t:
            x = (x @ a) * e[:, t]
        x = x / x.sum(axis=1, keepdims=True)
        alpha[:, t] = x
    for t in range(length - 2, -1, -1):
        b = (e[:, t + 1] * beta[:, t + 1]) @ a.T
        beta[:, t] = b / b.sum(axis=1, keepdims=True)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    pair = alpha[:, :-1, :, None] * a * (e[:, 1:] * beta[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return post, pair.sum(axis=(0, 1))


def fit(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model:
    return fit_segments(training_segments(docs.select("doc_id", "text", "lang"), docs_per_language))


# --- applying ----------------------------------------------------------------


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``, the mean posterior of that
    language over the words. Text that is null or has no letter gets ``und``
    and 0, as does everything under a model without languages. Ties go to the
    language first in code point order. Only the text is looked at."""

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if model.languages:
            for i, _, _, post in label_texts(texts.tolist(), model):
                mean = post.mean(axis=0)
                best = int(mean.argmax())
                lang[i], score[i] = model.languages[best], float(min(1.0, mean[best]))
        give_back()
        return pd.DataFrame({"lang_pred": lang, "score": score})

    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = text_batches(docs).withColumn("__found", run(F.col(text)))
    return found.select(*kept, F.col("__found.lang_pred").alias("lang_pred"), F.col("__found.score").alias("score"))


def language_spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``spans``: array of (start, end, lang, score), the runs of
    words with one label, in code points with the end exclusive."""
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(T.ArrayType(span))
    def run(texts: pd.Series) -> pd.Series:
        out: List[list] = [[] for _ in range(len(texts))]
        if model.languages:
            for i, first, end, post in label_texts(texts.tolist(), model):
                label = post.argmax(axis=1)
                cuts = np.flatnonzero(np.concatenate(([True], label[1:] != label[:-1])))
                for lo, hi in zip(cuts, np.append(cuts[1:], len(label))):
                    out[i].append((int(first[lo]), int(end[hi - 1]), model.languages[label[lo]], float(post[lo:hi, label[lo]].mean())))
        return pd.Series(out, dtype=object)

    return text_batches(docs).drop("spans").withColumn("spans", run(F.col(text)))


def op3_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), "lang_pred", "score")
