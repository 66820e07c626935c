"""A set of keys of fixed size, as a column: which of many rows may have one of the wanted keys.

A bit per hash of a key (a Bloom filter with one hash function), built by one
aggregate with map-side combine and held as 32 bitmaps of 4 KB per million
bits. Its size does not depend on the number of keys, so it can be sent everywhere; with
many keys it only lets more rows pass. It has no false negatives; an exact join
follows. All of it is built-in functions, inside a plan, without a job of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITMAP_BITS = 1 << 15                    # what bitmap_construct_agg holds
KEY_SET_BITS = 1 << 20


def _place(key: list[Column], bits: int) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(*key), F.lit(bits))
    return F.floor(at / BITMAP_BITS).cast("int"), (at % BITMAP_BITS)


def key_set(keys: DataFrame, *columns: str, bits: int = KEY_SET_BITS) -> Column:
    """The set of the rows' keys as a scalar: use it as a column of its own (``withColumn``)."""
    bucket, bit = _place([F.col(c) for c in columns], bits)
    maps = keys.select(bucket.alias("bucket"), bit.alias("bit")).groupBy("bucket").agg(
        F.bitmap_construct_agg("bit").alias("bitmap"))
    # At most bits / 32768 rows; buckets without a key have no bitmap.
    found = maps.agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bitmap"))).alias("m"))
    return found.select(F.transform(F.sequence(F.lit(0), F.lit(bits // BITMAP_BITS - 1)),
                                    lambda b: F.try_element_at("m", b))).scalar()


def in_key_set(the_set: Column, *key: Column, bits: int = KEY_SET_BITS) -> Column:
    """Whether a key may be in ``the_set`` (of the same number of bits)."""
    bucket, bit = _place(list(key), bits)
    byte = F.conv(F.hex(F.substring(F.get(the_set, bucket), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    return F.coalesce(F.bit_get(byte.cast("int"), (bit % 8).cast("int")) == 1, F.lit(False))
