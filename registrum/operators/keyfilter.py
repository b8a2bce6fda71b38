"""A Bloom filter of keys as a table of bitmaps, built, merged and asked with Spark's bitmap functions.

A key sets ``HASHES`` bits of ``bits``. The filter is kept as (bucket, bitmap) rows, one per 32,768 bits that
has any set, so its size is bounded by ``bits`` / 8 bytes whatever the number of keys, and filters of one
size are merged by OR. A key with an unset bit is surely not in the filter; one whose bits are all set may be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 2
BUCKET_BITS = 32_768
#: Least and largest filter (128 KB and 64 MB).
MIN_BITS, MAX_BITS = 1 << 20, 1 << 29


def filter_bits(keys: int) -> int:
    """Bits of a table's filters from the keys of its first batch: 16 or more per key, a power of two, so
    that some 1.4 % of unknown keys pass when as many keys are in it; MAX_BITS holds 33 million keys so."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (16 * max(1, keys) - 1).bit_length()))


def _positions(key: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.col(key), F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def key_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(bucket, bitmap) of the present keys; each task ORs its own bits first."""
    at = keys.filter(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(key, bits))).alias("_p"))
    # the bitmap functions count buckets from 1 for the positions from 1
    return at.groupBy(F.bitmap_bucket_number(F.col("_p") + 1).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_p") + 1)).alias("bitmap"))


def merged_filter(filters: DataFrame) -> DataFrame:
    return filters.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _is_set(bitmap: Column, position: Column) -> Column:
    """Whether the bit of a bucket's bitmap is set; False where there is no bitmap."""
    bit = F.bitmap_bit_position(position + 1)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def ask(keys: DataFrame, key: str, merged: DataFrame, bits: int, flag: str = "maybe") -> DataFrame:
    """``keys`` with whether each may be in the filter. The filter has a set size and is broadcast."""
    out = keys
    for i, position in enumerate(_positions(key, bits)):
        side = F.broadcast(merged.select(F.col("bucket").alias(f"_b{i}"), F.col("bitmap").alias(f"_m{i}")))
        out = out.join(side, F.bitmap_bucket_number(position + 1) == F.col(f"_b{i}"), "left")
    hits = [_is_set(F.col(f"_m{i}"), p) for i, p in enumerate(_positions(key, bits))]
    found = hits[0]
    for h in hits[1:]:
        found = found & h
    return out.withColumn(flag, found).select(*keys.columns, flag)


def batches_asked(keys: DataFrame, key: str, filters: DataFrame, batch: str, bits: int) -> list[int]:
    """The batches whose own filter (rows with ``batch``) may hold one of the keys, a bounded broadcast side."""
    at = keys.select(F.col(key).alias("_k"), F.posexplode(F.array(*_positions(key, bits))).alias("_i", "_p"))
    at = F.broadcast(at.withColumn("_bucket", F.bitmap_bucket_number(F.col("_p") + 1)))
    met = filters.join(at, filters["bucket"] == F.col("_bucket")).filter(_is_set(F.col("bitmap"), F.col("_p")))
    whole = met.groupBy(batch, "_k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == HASHES)
    return sorted(r[0] for r in whole.select(batch).distinct().collect())
