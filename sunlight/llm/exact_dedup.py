"""Exact deduplication with two-pass Bloom filtering.

Pass 1 builds, over the SHA-256 of every text, a Bloom filter of the bits
that at least two rows set. Each task sends one compact list of bit offsets
per 64 Ki-bit segment (a hash that occurs often in a task is sent at most
twice), and segments are merged on executors. Pass 2 probes it: a row whose
bits are not all set by two or more rows cannot have an equal, and passes
straight through; only the other rows shuffle, on their hash.

The filter is the one broadcast, of at most ``max_bits`` (32 MB by default). Where that
many bits are too few for the rows, rows are dealt by their hash to slices, stored by slice, and each
slice has a filter of its own, one after the other: the share of single rows that pass does not
grow with the input, and no task or driver holds more than one filter.

Defined cases: a null text counts as the empty text. A null doc_id is the
smallest in the choice of the row that stays. If the largest doc_id of a
group is on several rows, exactly one of them is ``kept``. An empty table
gives an empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sunlight.session import scratch_path

from .common import stash

SEGMENT_BITS = 1 << 16
MAX_BITS = 1 << 28
BITS_PER_ROW = 16
PROBES = 3


def filter_bits(rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> int:
    """Filter size for ``rows`` rows: a power of two within the bounds."""
    want = max(SEGMENT_BITS, rows * bits_per_row)
    return min(max_bits, 1 << (want - 1).bit_length())


def slice_count(rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> int:
    """Filters of at most ``max_bits`` bits that ``rows`` rows need."""
    return max(1, -(-rows * bits_per_row // max_bits))


def _slots(digests, bits: int) -> np.ndarray:
    """(rows, PROBES) bit positions, read from the digests themselves."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)
    return (words[:, :PROBES] & np.uint64(bits - 1)).astype(np.int64)


def _partial_filters(bits: int):
    def run(batches):
        once, twice = [], []
        for b in batches:
            slots = _slots(b["sha"], bits)
            if not len(slots):
                continue
            # equal digests of a batch count together, two at most
            rows, n = np.unique(slots, axis=0, return_counts=True)
            once.append(rows.ravel())
            twice.append(rows[n > 1].ravel())
        if not once:
            return
        pos, n = np.unique(np.concatenate(once + twice), return_counts=True)
        seg = pos // SEGMENT_BITS
        off = (pos % SEGMENT_BITS).astype("<u2")
        cut = np.flatnonzero(np.diff(seg)) + 1
        starts, ends = np.r_[0, cut], np.r_[cut, len(seg)]
        yield pd.DataFrame({
            "segment": seg[starts],
            "seen": [off[s:e].tobytes() for s, e in zip(starts, ends)],
            "again": [off[s:e][n[s:e] > 1].tobytes() for s, e in zip(starts, ends)]})
    return run


def _merge_segment(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    count = np.zeros(SEGMENT_BITS, dtype=np.int64)
    for col in ("seen", "again"):
        count += np.bincount(np.frombuffer(b"".join(parts[col]), dtype="<u2"), minlength=SEGMENT_BITS)
    return pd.DataFrame({"segment": [key[0]],
                         "bits": [np.packbits(count > 1, bitorder="little").tobytes()]})


def repeated_filter(spark: SparkSession, hashed: DataFrame, bits: int) -> bytes:
    """Bitmap (``bits`` / 8 bytes) of the positions set by at least two rows of ``hashed.sha``."""
    merged = (hashed.select("sha")
              .mapInPandas(_partial_filters(bits), "segment long, seen binary, again binary")
              .groupBy("segment").applyInPandas(_merge_segment, "segment long, bits binary"))
    out = bytearray(bits // 8)
    step = SEGMENT_BITS // 8
    for row in merged.toLocalIterator():
        out[row["segment"] * step:(row["segment"] + 1) * step] = row["bits"]
    return bytes(out)


def _marked(spark: SparkSession, hashed: DataFrame, bits: int) -> DataFrame:
    """``hashed`` with ``maybe``: whether a row can have an equal."""
    bitmap = spark.sparkContext.broadcast(repeated_filter(spark, hashed, bits))

    @F.pandas_udf("boolean")
    def maybe_repeated(sha: pd.Series) -> pd.Series:
        bitmap_bytes = np.frombuffer(bitmap.value, dtype=np.uint8)
        slots = _slots(sha, bits)
        return pd.Series(((bitmap_bytes[slots >> 3] >> (slots & 7)) & 1).all(axis=1))

    return hashed.withColumn("maybe", maybe_repeated("sha"))


def _marked_by_slice(spark: SparkSession, hashed: DataFrame, bits: int, slices: int) -> DataFrame:
    """Like ``_marked``, with a filter for each slice of the hashes; a slice is read from its own folder.

    Equal texts are in one slice. The last word of a digest, which no probe reads, gives the slice.
    """
    last = F.conv(F.hex(F.substring("sha", 26, 7)), 16, 10).cast("long")
    by_slice = scratch_path(spark, "llm-exact-slices")
    hashed.withColumn("slice", F.pmod(last, F.lit(slices)).cast("int")).write.partitionBy("slice").parquet(by_slice)
    stored = spark.read.schema("doc_id long, sha binary, row_id long, slice int").parquet(by_slice)
    out = scratch_path(spark, "llm-exact-marked")
    for k in range(slices):
        # Written slice by slice: one filter at a time is needed anywhere.
        _marked(spark, stored.where(F.col("slice") == k).drop("slice"), bits).write.mode("append").parquet(out)
    return spark.read.schema("doc_id long, sha binary, row_id long, maybe boolean").parquet(out)


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, sha (binary)."""
    hashed = stash(spark, docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("sha"),
        F.monotonically_increasing_id().alias("row_id")), "exact-hashes")
    rows = hashed.count()
    slices = slice_count(rows, max_bits=max_bits)
    bits = filter_bits(-(-rows // slices), max_bits=max_bits)
    marked = _marked(spark, hashed, bits) if slices == 1 else _marked_by_slice(spark, hashed, bits, slices)
    single = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    some = marked.where("maybe").drop("maybe")
    # Written, so that the join's sides are plain scans and a group of very many copies can be split.
    groups = stash(spark, some.groupBy("sha").agg(F.max(F.struct("doc_id", "row_id")).alias("top"),
                                                  F.count(F.lit(1)).alias("group_size")), "exact-groups")
    several = some.join(groups, "sha").select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("top.row_id")).alias("kept"), "sha")
    return single.unionByName(several)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("sha")).alias("text_sha256"))


OP10_SQL = """
WITH hashed AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
SELECT d.doc_id, g.top AS keep_id, g.n AS group_size, d.doc_id = g.top AS kept, d.h AS text_sha256
FROM hashed d JOIN (SELECT h, max(doc_id) AS top, count(*) AS n FROM hashed GROUP BY h) g ON d.h = g.h
"""
