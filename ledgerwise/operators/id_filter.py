"""A bitmap of hashed ids that prunes a large side before it is shuffled.

The filter of a feed's ids is a few thousand rows of 4 KB at most, so it is
broadcast, and a row of the large side whose id's bit is not set cannot match.
What passes by chance is one row in FALSE_ONE_IN; with more than MAX_BITS /
FALSE_ONE_IN ids the share grows, up to passing everything. It never decides a
match: a join follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FALSE_ONE_IN = 16
BUCKET_BITS = 1 << 15  # of Spark's bitmap functions: 4 KB each
MAX_BITS = 1 << 28  # 32 MB in 8192 rows


def filter_bits(rows: int) -> int:
    """Size for so many ids: a power of two between one bucket and MAX_BITS."""
    return min(MAX_BITS, max(BUCKET_BITS, 1 << max(0, FALSE_ONE_IN * rows - 1).bit_length()))


def _place(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def id_filter(ids: DataFrame, key: str, bits: int) -> DataFrame:
    """``_bucket, _bitmap`` of the non-null ids."""
    place = _place(F.col(key), bits)
    known = ids.filter(F.col(key).isNotNull())
    return known.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bitmap"))


def maybe_in(df: DataFrame, key: str, ids: DataFrame, bits: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among the ids of an :func:`id_filter`:
    every row that is, and a few others; none with a NULL key."""
    place = _place(F.col(key), bits)
    # The coalesce changes no value: without it a not-null filter is derived for
    # the ids, and an exchange in their plan cannot serve the join as well.
    own, known = (F.coalesce(c, F.lit(-1)) for c in (F.bitmap_bucket_number(place), F.col("_bucket")))
    met = df.join(F.broadcast(ids), own == known)
    at = F.bitmap_bit_position(place)
    byte = F.ascii(F.decode(F.substring("_bitmap", F.floor(at / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    bit = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (at % 8).cast("int") + 1)
    return met.filter(F.col(key).isNotNull() & (byte.bitwiseAND(bit) != 0)).select(*df.columns)
