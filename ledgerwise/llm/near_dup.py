"""Near-duplicate documents by BagMinHash over five-word shingles.

A text is the multiset of its shingles. Each shingle runs Poisson processes
over its weight axis, split at the powers of two: the process of (0, 1] and
those of (2**(k-1), 2**k], with a rate as long as the interval. A point has a
time, a component and a level; it counts if its level is within the shingle's
multiplicity. A component's value is its first counting point over all
shingles, so two texts agree in it with the probability of their weighted
Jaccard similarity, and only points up to the time that fills all components
are ever made.

Bands of components give candidates. Within a bucket nobody is paired with
everybody: each member meets the bucket's smallest id, and where the two share
two bands or more, exact multiset overlap decides; links are united. Buckets
that still hold several components are compared in blocks by their signatures,
between components only: a block with few agreeing pairs names them, a block
with many is verified as a whole, its overlaps counted together, and gives
links that span its components. Texts that are equal take part once. Texts are
read again only for documents that a fixed-size bitmap of the candidates lets
through, so they are never shuffled.
"""

from __future__ import annotations

from functools import lru_cache
from typing import Iterator, List, Sequence, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwise.llm.common import connected_components, give_back, partitions, stage, text_batches

SHINGLE = 5
SIMILARITY = 0.8
COMPONENTS = 120
ROWS = 5
BANDS = COMPONENTS // ROWS
#: Signature agreement from which a pair is verified: five standard deviations
#: below the similarity.
AGREEMENT = 0.62
BLOCK_MEMBERS = 2048
#: A block names its pairs up to this many per member; beyond, it is dense.
PAIRS_PER_MEMBER = 8
#: Bits of the candidates' bitmap: 8 MB, whatever the input. A fuller bitmap
#: lets more documents through than needed, never fewer.
FILTER_BITS = 1 << 26
BITMAP_BITS = 32768
BLOCK_BYTES = 1 << 20

U = np.uint64
C1, C2, C3 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
WORD_BASE = U(0x9FB21C651E98DF25)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * C2
    x = (x ^ (x >> U(27))) * C3
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def _blank() -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([U(1)], np.full(max(0, n - 1), WORD_BASE, dtype=U))))


def shingles(texts: Sequence[str]) -> Tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash), one row per shingle occurrence, texts in
    order. Words are runs without [\\x20\\x09-\\x0D]; a text of fewer than five
    words is one shingle, a text without words none."""
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer(b"\n" + b"\n".join(data) + b"\n", dtype=np.uint8)
    inside = ~_blank()[raw]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, end = edge[0::2], edge[1::2]
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, U)
    at = np.flatnonzero(inside)
    length = end - first
    at0 = np.concatenate(([0], np.cumsum(length)[:-1]))
    place = np.arange(len(at)) - np.repeat(at0, length)
    words = mix64(np.add.reduceat((raw[at].astype(U) + U(1)) * _powers(int(length.max()))[place], at0) + length.astype(U) * C1)
    starts = np.concatenate(([1], 1 + np.cumsum([len(d) + 1 for d in data])))
    owner = np.searchsorted(starts, first, side="right") - 1
    per_text = np.bincount(owner, minlength=len(texts))

    combined = np.zeros(len(words), dtype=U)
    padded = np.concatenate([words, np.zeros(SHINGLE, dtype=U)])
    salt = mix64(np.arange(1, SHINGLE + 1, dtype=U) * C1) | U(1)
    for j in range(SHINGLE):
        combined += padded[j : j + len(words)] * salt[j]
    text0 = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    left = per_text[owner] - (np.arange(len(words)) - text0[owner])
    whole = left >= SHINGLE
    short = np.flatnonzero((per_text > 0) & (per_text < SHINGLE))
    for t in short:  # fewer than five words: all of them at the first word's place
        lo = text0[t]
        n = per_text[t]
        combined[lo] = (words[lo : lo + n] * salt[:n]).sum(dtype=U) + U(int(n))
        whole[lo] = True
    return owner[whole], mix64(combined[whole])


def bags(owner: np.ndarray, hashes: np.ndarray) -> Tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, multiplicity), sorted."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))


def _uniform(x: np.ndarray) -> np.ndarray:
    return ((x >> U(11)).astype(np.float64) + 1.0) * 2.0**-53


def _step(n: int) -> np.uint64:
    return U((n * int(C1)) % 2**64)


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """n x m first times, inf for bags without elements. A pass makes all
    points up to a time that likely fills every component; texts with an empty
    one get a pass that goes twice as far."""
    total = np.bincount(owner, weights=weight, minlength=n)
    out = np.full((n, m), np.inf)
    todo = total > 0
    reach = m * (np.log(m) + 4.0)
    while todo.any():
        own = todo[owner]
        out[todo] = np.inf
        _points(owner[own], element[own], weight[own], reach / np.maximum(total, 1), out, m)
        todo &= np.isinf(out).any(axis=1)
        reach *= 2
    return out


def _points(owner, element, weight, until, out, m) -> None:
    # intervals: 0 is (0, 1], k is (2**(k-1), 2**k]
    last = np.ceil(np.log2(weight)).astype(np.int64)
    reps = last + 1
    k = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
    owner, element, weight = np.repeat(owner, reps), np.repeat(element, reps), np.repeat(weight, reps)
    low = np.where(k > 0, 2.0 ** (k - 1), 0.0)
    rate = np.where(k > 0, low, 1.0)
    stream = mix64(element + k.astype(U) * C1)
    time = np.zeros(len(owner))
    limit = until[owner]
    step = 0
    flat = out.reshape(-1)
    while len(owner):
        step += 1
        r = mix64(stream + _step(2 * step))
        time = time - np.log(_uniform(r)) / rate
        live = time < limit
        owner, stream, time, rate, low, weight, limit = (x[live] for x in (owner, stream, time, rate, low, weight, limit))
        r = mix64(stream + _step(2 * step + 1))
        level = np.ceil(low + rate * _uniform(mix64(r)))
        counts = (level <= weight) | (rate == 1.0) & (low == 0.0)
        np.minimum.at(flat, owner[counts] * m + (r[counts] % U(m)).astype(np.int64), time[counts])


def band_keys(times: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """n x bands hashes of consecutive components and the band's number."""
    ids = mix64(times.view(U))
    parts = ids.reshape(len(ids), -1, rows)
    salt = mix64(np.arange(1, rows + 1, dtype=U) * C3) | U(1)
    band = mix64(np.arange(1, parts.shape[1] + 1, dtype=U) * C2)
    return mix64((parts * salt).sum(axis=2, dtype=U) + band)


def _groups(texts: Sequence[str]) -> Iterator[Tuple[int, int]]:
    """Runs of texts of about BLOCK_BYTES characters."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > BLOCK_BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(t or "")
    if lo < len(texts):
        yield lo, len(texts)


def signature_table(docs: DataFrame, m: int = COMPONENTS, rows: int = ROWS) -> DataFrame:
    """doc_id, h1, h2 (hash of the text), bands (none for a text without words)
    and sig (m little-endian uint32) for documents with an id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in _groups(texts):
                owner, hashes = shingles(texts[lo:hi])
                times = signatures(*bags(owner, hashes), hi - lo, m)
                some = np.isfinite(times[:, 0])
                keys = band_keys(times, rows).view(np.int64)
                sig = (mix64(times.view(U)) & U(0xFFFFFFFF)).astype("<u4")
                own = batch.iloc[lo:hi]
                yield pd.DataFrame({
                    "doc_id": own["doc_id"].to_numpy(), "h1": own["h1"].to_numpy(), "h2": own["h2"].to_numpy(),
                    "bands": [k if s else k[:0] for k, s in zip(keys, some)], "sig": [s.tobytes() for s in sig],
                })
                del owner, hashes, times, keys, sig
                give_back()

    text = F.coalesce(F.col("text"), F.lit(""))
    src = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"), text.alias("text")
    )
    return text_batches(src).mapInPandas(run, "doc_id long, h1 long, h2 long, bands array<long>, sig binary")


def candidate_filter(ids: DataFrame) -> DataFrame:
    """``bucket, bitmap`` of hashed ids: at most FILTER_BITS / BITMAP_BITS rows
    of 4 KB."""
    spread = _spread(F.col("doc_id"))
    return ids.groupBy(F.bitmap_bucket_number(spread).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spread)).alias("bitmap"))


def _spread(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS)) + 1


def bag_table(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, bag: at least the documents of ``ids`` as sorted arrays in which
    the n-th occurrence of a shingle is an element of its own. Documents come
    through a broadcast bitmap of fixed size, so no text is shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in _groups(texts):
                owner, element, weight = bags(*shingles(texts[lo:hi]))
                nth = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
                coded = mix64(np.repeat(element, weight) + nth.astype(U) * C1).view(np.int64)
                cuts = np.searchsorted(np.repeat(owner, weight), np.arange(hi - lo + 1))
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[lo:hi].to_numpy(), "bag": [coded[a:b] for a, b in zip(cuts[:-1], cuts[1:])]})
                del owner, element, weight, nth, coded
                give_back()

    own = docs.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    place = F.bitmap_bit_position(_spread(F.col("doc_id")))
    met = own.join(F.broadcast(candidate_filter(ids)), F.bitmap_bucket_number(_spread(F.col("doc_id"))) == F.col("bucket"))
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = byte.bitwiseAND(F.expr("1").cast("int") * F.pow(F.lit(2), place % 8).cast("int")) != 0
    return text_batches(met).filter(there).select("doc_id", "text").mapInPandas(run, "doc_id long, bag array<long>")


def verified(pairs: DataFrame, bag: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity reaches the
    threshold. The nested loops of a join never meet: both joins are by id."""
    left, right = bag.toDF("a", "bag_a"), bag.toDF("b", "bag_b")
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("bag_a", "bag_b"))
    union = F.size("bag_a") + F.size("bag_b") - common
    return both.filter(common >= F.lit(similarity) * union).select("a", "b")


def _blocks(run_block, key: Sequence[str]):
    """Runs ``run_block`` on every group of consecutive rows with one key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: List[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            block = batch[key].to_numpy()
            cuts = [0, *(np.flatnonzero((block[1:] != block[:-1]).any(axis=1)) + 1), len(block)]
            done: List[pd.DataFrame] = []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if waiting and (waiting[-1][key].iloc[0].to_numpy() != block[lo]).any():
                    done.append(run_block(pd.concat(waiting)))
                    waiting = []
                waiting.append(batch.iloc[lo:hi])
            if done:
                yield pd.concat(done)
                give_back()
        if waiting:
            yield run_block(pd.concat(waiting))
        give_back()

    return run


BLOCK = ["key", "i", "j"]
FOUND = "kind string, key long, i int, j int, a long, b long"


def agreeing(agreement: float):
    """One block of a bucket (chunks i and j of its members, with component
    and signature) to its agreeing pairs of different components (kind
    ``pair``), or, where they are many, to the members that have one (kind
    ``dense``, id in ``a``, chunk in ``b``)."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["doc_id"])
        i, j = int(block["i"].iloc[0]), int(block["j"].iloc[0])
        left, right = block[block["chunk"] == i], block[block["chunk"] == j]
        head = {"key": np.int64(block["key"].iloc[0]), "i": np.int32(i), "j": np.int32(j)}
        columns = ["kind", *BLOCK, "a", "b"]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=columns)
        a, b = (np.stack([np.frombuffer(s, "<u4") for s in x["sig"]]) for x in (left, right))
        agree = np.zeros((len(a), len(b)), dtype=np.int16)
        for c in range(a.shape[1]):
            agree += a[:, c][:, None] == b[:, c][None, :]
        hit = (agree >= agreement * a.shape[1]) & (left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :])
        if i == j:
            hit = np.triu(hit, 1)
        ids_a, ids_b = left["doc_id"].to_numpy(), right["doc_id"].to_numpy()
        if hit.sum() <= PAIRS_PER_MEMBER * (len(a) + len(b)):
            r, c = np.nonzero(hit)
            x, y = ids_a[r], ids_b[c]
            return pd.DataFrame({"kind": "pair", **head, "a": np.minimum(x, y), "b": np.maximum(x, y)})[columns]
        sides = [(ids_a[hit.any(axis=1)], i), (ids_b[hit.any(axis=0)], j)]
        return pd.concat([pd.DataFrame({"kind": "dense", **head, "a": x, "b": np.int64(n)})[columns] for x, n in sides])

    return run


def overlaps(owner: np.ndarray, element: np.ndarray, n: int) -> np.ndarray:
    """n x n counts of common elements. Elements of few bags add their pairs,
    elements of many go through a matrix product, some columns at a time."""
    order = np.lexsort((owner, element))
    owner, element = owner[order], element[order]
    first = np.flatnonzero(np.concatenate(([True], element[1:] != element[:-1])))
    size = np.diff(np.append(first, len(element)))
    out = np.zeros((n, n), dtype=np.float32)
    for length in np.unique(size):
        at = first[size == length]
        if length < 2:
            continue
        if length <= 32:
            step = max(1, (1 << 22) // int(length) ** 2)
            for lo in range(0, len(at), step):
                who = owner[at[lo : lo + step, None] + np.arange(length)]
                flat = (who[:, :, None] * n + who[:, None, :]).ravel()
                out += np.bincount(flat, minlength=n * n).reshape(n, n)
        else:
            for lo in range(0, len(at), 1024):
                cols = at[lo : lo + 1024]
                m = np.zeros((n, len(cols)), dtype=np.float32)
                m[owner[cols[:, None] + np.arange(length)], np.arange(len(cols))[:, None]] = 1
                out += m @ m.T
    return out


def spanning(similarity: float):
    """One dense block, with bags, to links that span what its exact
    similarities connect."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["doc_id"])
        ids = block["doc_id"].to_numpy()
        length = block["bag"].map(len).to_numpy()
        element = np.concatenate([np.asarray(x, dtype=np.int64) for x in block["bag"]])
        common = overlaps(np.repeat(np.arange(len(ids)), length), element, len(ids))
        hit = common >= similarity * (length[:, None] + length[None, :] - common)
        seen, a, b = np.zeros(len(ids), dtype=bool), [], []
        for root in range(len(ids)):
            if seen[root]:
                continue
            seen[root], front = True, [root]
            while front:
                x = front.pop()
                fresh = np.flatnonzero(hit[x] & ~seen)
                seen[fresh] = True
                front += fresh.tolist()
                a += [ids[x]] * len(fresh)
                b += ids[fresh].tolist()
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}, dtype="int64")

    return run


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, m: int = COMPONENTS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id, kept`` for every row of ``docs(doc_id, text)``:
    class_id is the smallest doc_id that links reach, and kept marks it.

    Equal texts are always one class; a text without words is linked with no
    other text; rows sharing a doc_id are one document. A null doc_id is a class
    of its own, null, and kept."""
    table = stage(signature_table(docs, m, rows), "signatures")
    first = table.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"))
    members = stage(table.select("doc_id", "h1", "h2").join(first, ["h1", "h2"]).select("doc_id", "rep").distinct(), "members")
    reps = members.select(F.col("rep").alias("doc_id")).distinct()

    wide = table.select("doc_id", "bands").join(reps, "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("key"))
    buckets = wide.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("centre"), F.max("doc_id").alias("last"))
    buckets = buckets.filter(F.col("centre") < F.col("last")).drop("last")
    shared = stage(wide.join(buckets, "key"), "buckets")

    star = shared.filter(F.col("doc_id") != F.col("centre")).groupBy(F.col("centre").alias("a"), F.col("doc_id").alias("b"))
    star = star.agg(F.count(F.lit(1)).alias("bands")).filter(F.col("bands") > 1)
    star = stage(star.select("a", "b"), "stars")
    links = stage(verified(star, bag_table(docs, _ends(star)), similarity), "links")
    nodes = reps.select(F.col("doc_id").alias("id"))
    found = connected_components(nodes, links)

    # what is left: buckets with several components
    placed = shared.join(found.withColumnRenamed("id", "doc_id"), "doc_id")
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter(F.col("lo") < F.col("hi"))
    chunks = F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int")
    rest = placed.join(mixed.select("key"), "key").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), chunks).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1))).join(table.select("doc_id", "sig"), "doc_id")
    rest = rest.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "doc_id", "chunk", "component", "sig")
    rest = rest.repartition(partitions(docs), *BLOCK).sortWithinPartitions(*BLOCK, "doc_id")  # a number: blocks are small rows but long work, not to be merged
    late = stage(rest.mapInPandas(_blocks(agreeing(AGREEMENT), BLOCK), FOUND), "late")

    pairs = late.filter("kind = 'pair'").select("a", "b").distinct().join(star, ["a", "b"], "left_anti")
    dense = late.filter("kind = 'dense'")
    bag = stage(bag_table(docs, _ends(pairs).unionByName(dense.select(F.col("a").alias("doc_id")))), "bags")
    blocks = dense.select(*BLOCK, F.col("a").alias("doc_id")).join(bag, "doc_id").select(*BLOCK, "doc_id", "bag")
    blocks = blocks.repartition(partitions(docs), *BLOCK).sortWithinPartitions(*BLOCK, "doc_id")
    spans = blocks.mapInPandas(_blocks(spanning(similarity), BLOCK), "a long, b long")
    links = links.unionByName(verified(pairs, bag, similarity)).unionByName(spans).unionByName(_shared_ids(members))
    found = connected_components(nodes, links)

    classes = members.join(found.select(F.col("id").alias("rep"), "component"), "rep").groupBy("doc_id").agg(F.min("component").alias("class_id"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(classes, "doc_id", "left")
    out = out.withColumn("class_id", F.coalesce("class_id", "doc_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))


def _shared_ids(members: DataFrame) -> DataFrame:
    """Links between the texts of a repeated doc_id."""
    several = members.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("top")).filter(F.col("a") < F.col("top"))
    return members.join(several, "doc_id").select("a", F.col("rep").alias("b")).filter(F.col("a") != F.col("b"))


def op10_near_dup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
