"""SimHash near-duplicates through a byte-position inverted index.

A 64-bit fingerprint is eight positional bytes. Two fingerprints within
``max_bits`` differing bits share at least ``8 - max_bits`` of them: that is
the count filter. Posting lists of single (position, byte) values would each
hold 1/256 of the corpus, and tallying inside them all pairs of the corpus,
so the postings here are sets of positions: the positions are split into
``8 - max_bits - 1`` or fewer classes such that any set of the guaranteed size
contains one of the posted sets (Turan's covering). Every pair that could
pass the count filter thus meets in some list; inside a list the shared
positional bytes of a pair are tallied on the whole fingerprints, pairs below
the guaranteed count are dropped, and the bit distance verifies the rest.

Equal fingerprints are collapsed first, so lists hold different ones. A short
list compares its pairs by shifted arrays. A long one is searched outward
from one member at a time, over the members not yet reached: near copies in
their thousands are joined by a spanning forest of verified links in about
linear work, and no list emits its pairs. A list over ``BLOCK`` members is cut
in blocks and every pair of blocks is its own group, so no task holds an
unbounded list. Links then form classes by connected components.

Defined cases: null, empty and blank texts have fingerprint zero and are
linked like any other; repeated rows are all returned; a null doc_id counts
as the largest id in the choice of the class id. An empty table gives an
empty result. Other columns are ignored (``simhash_dedup`` passes them on,
and there rows are told apart by a number of their own, so rows without id or
with the same id and other texts go only with their own classes).
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import doc_key, from_key, stash, table
from .components import connected_components

SHINGLE = 4
MAX_BITS = 4
SHORT_LIST = 64
BLOCK = 1 << 15
HASHES_AT_ONCE = 1 << 16


# -- fingerprints ---------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is 1 if more than half of the shingle hashes set it."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []   # ASCII case and space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[:-1] + 1][:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        hashes = np.array([digest(joined[s:e], 42) for s, e in
                           zip(starts[at:at + HASHES_AT_ONCE], stops[at:at + HASHES_AT_ONCE])], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE,
                 row: Column | None = None) -> DataFrame:
    """(doc, row, fp): fingerprint as a signed long for each row, and the number ``row`` (0 if not given)."""
    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["doc", "row", "fp"])
    return docs.select(doc_key(id_col).alias("doc"), (F.lit(0) if row is None else row).cast("long").alias("row"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc long, row long, fp long")


# -- byte-position postings -----------------------------------------------

def posted_positions(size: int, shared: int) -> list[tuple[int, ...]]:
    """Sets of ``size`` byte positions of which any ``shared`` positions contain one.

    The positions fall in classes; by pigeonhole, ``shared`` positions put
    ``size`` into one of ``(shared - 1) // (size - 1)`` classes. Triples of four
    take three classes in a ring: three of one class, or two of one and one of
    the next.
    """
    if size == 1:
        return [(p,) for p in range(9 - shared)]
    if (size, shared) == (3, 4):
        ring = [list(range(8))[i::3] for i in range(3)]
        return [t for i in range(3) for t in
                [*itertools.combinations(ring[i], 3),
                 *((*two, one) for two in itertools.combinations(ring[i], 2) for one in ring[(i + 1) % 3])]]
    classes = (shared - 1) // (size - 1)
    groups = [list(range(8))[i::classes] for i in range(classes)]
    return [c for g in groups for c in itertools.combinations(g, size)]


def posted_size(rows: int, shared: int) -> int:
    """Bytes per posting: as many as keep an even list at about ``SHORT_LIST`` members."""
    size = 1
    while size < shared and rows > SHORT_LIST * 256 ** size:
        size += 1
    return size


def _near(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """Tally of shared positional bytes reaches the guaranteed count, then the bit distance."""
    diff = np.atleast_1d(x ^ y)
    shared = (diff.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    ok = shared >= 8 - max_bits
    ok[ok] = np.bitwise_count(diff[ok]) <= max_bits
    return ok


def _forest(own: np.ndarray, other: np.ndarray | None, max_bits: int) -> list[tuple[int, int]]:
    """Verified links that join what is linked within ``own`` (or between it and ``other``).

    Outward search: each reached member looks only at members not reached yet.
    """
    links = []
    sides = [own, own if other is None else other]
    left = [np.ones(len(own), bool), np.ones(len(sides[1]), bool)]
    if other is None:
        left[1] = left[0]
    for seed in range(len(own)):
        if not left[0][seed]:
            continue
        left[0][seed] = False
        todo = [(0, seed)]
        while todo:
            side, i = todo.pop()
            across = 1 - side
            open_ = np.flatnonzero(left[across])
            if not len(open_):
                continue
            hit = open_[_near(sides[across][open_], sides[side][i], max_bits)]
            left[across][hit] = False
            todo.extend((across, j) for j in hit.tolist())
            links.extend((int(sides[side][i]), int(sides[across][j])) for j in hit.tolist())
    return links


def _list_links(fps: np.ndarray, block: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of one long list or pair of blocks."""
    first, second = fps[block == 0], fps[block == 1]
    return _forest(first, second if len(second) else None, max_bits)


def _links(max_bits: int):
    """Links inside the posting lists of a partition sorted by list."""
    def short(key, fps):
        for shift in range(1, SHORT_LIST):
            same = np.flatnonzero(key[shift:] == key[:-shift]) if len(key) > shift else []
            if not len(same):
                return
            x, y = fps[same], fps[same + shift]
            ok = _near(x, y, max_bits)
            yield x[ok], y[ok]

    def emit(keys, fps, blocks):
        """Whole lists only."""
        starts = np.r_[0, np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1]
        sizes = np.diff(np.r_[starts, len(keys)])
        ordinal = np.repeat(np.arange(len(starts)), sizes)
        plain = (np.repeat(sizes, sizes) <= SHORT_LIST) & (keys[:, 2] == keys[:, 3])
        out = [np.column_stack(p) for p in short(ordinal[plain], fps[plain])]
        for n in np.flatnonzero((sizes > SHORT_LIST) | (keys[starts, 2] != keys[starts, 3])):
            cut = slice(starts[n], starts[n] + sizes[n])
            found = _list_links(fps[cut], blocks[cut], max_bits)
            if found:
                out.append(np.array(found, dtype=np.uint64).reshape(-1, 2))
        if out:
            both = np.concatenate(out).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def run(batches):
        held = []   # rows of lists that may go on in the next batch
        for batch in batches:
            keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(4)]).astype(np.int64)
            fps = batch.column(4).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            blocks = batch.column(5).to_numpy(zero_copy_only=False).astype(np.int8)
            if not len(keys):
                continue
            if held and np.array_equal(held[-1][0][-1], keys[0]) and np.array_equal(keys[0], keys[-1]):
                held.append((keys, fps, blocks))     # the whole batch belongs to the held list
                continue
            if held:
                keys, fps, blocks = (np.concatenate([h[i] for h in held] + [x])
                                     for i, x in enumerate((keys, fps, blocks)))
            last = len(keys) - int(np.argmax(np.any(keys[::-1] != keys[-1], axis=1))) \
                if np.any(keys != keys[-1]) else 0
            if last:
                yield from emit(keys[:last], fps[:last], blocks[:last])
            held = [(keys[last:], fps[last:], blocks[last:])]
        if held:
            yield from emit(*(np.concatenate([h[i] for h in held]) for i in range(3)))
    return run


def near_links(spark: SparkSession, fps: DataFrame, rows: int, max_bits: int = MAX_BITS,
               block: int = BLOCK) -> DataFrame:
    """(a, b): verified links between different fingerprints that join every class.

    ``fps`` holds different fingerprints in column ``fp``; ``rows`` is their count.
    """
    sets = posted_positions(posted_size(rows, 8 - max_bits), 8 - max_bits)
    byte = lambda p: F.shiftrightunsigned(F.col("fp"), 8 * p).bitwiseAND(F.lit(255))
    lists = F.array(*[F.struct(
        F.lit(n).alias("set"),
        sum((F.shiftleft(byte(p), 8 * i) for i, p in enumerate(s)), F.lit(0).cast("long")).alias("bytes"))
        for n, s in enumerate(sets)])
    postings = fps.select("fp", F.explode(lists).alias("l")).select("l.set", "l.bytes", "fp")
    long_lists = postings.groupBy("set", "bytes").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block) \
        .select("set", "bytes", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = postings.join(long_lists, ["set", "bytes"], "left") \
        .withColumn("blocks", F.coalesce("blocks", F.lit(1))) \
        .select("set", "bytes", "fp", mine.alias("mine"),
                F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("peer")) \
        .select("set", "bytes", F.least("mine", "peer").alias("low"), F.greatest("mine", "peer").alias("high"),
                "fp", (F.col("mine") > F.col("peer")).cast("int").alias("side"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["set", "bytes", "low", "high"]
    return dealt.repartition(parts, *keys).sortWithinPartitions(*keys) \
        .mapInArrow(_links(max_bits), "a long, b long")


def simhash_classes(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK,
                    row: Column | None = None) -> DataFrame:
    """One row per document: doc (see ``doc_key``), row (as given, else 0), fp (signed long),
    component (same coding as doc) and root, one fp for each class."""
    marked = stash(spark, fingerprints(docs, id_col, text_col, shingle, row), "simhash-docs")
    distinct = stash(spark, marked.groupBy("fp").agg(F.min("doc").alias("first")), "simhash-fps")
    links = near_links(spark, distinct, distinct.count(), max_bits, block)
    roots = connected_components(spark, links)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(firsts, "root").select("fp", "component", "root")
    return marked.join(named, "fp").select("doc", "row", "fp", "component", "root")


def simhash_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without near-duplicates: the row with the least id of each class stays, of equal ids the first.

    Rows are numbered by a write, so that each is told from those of the same id or without one.
    """
    names = docs.columns
    numbered = stash(spark, docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("kept")),
        "simhash-rows")
    inner = numbered.select("row", F.col("kept").getField(id_col).alias("id"), F.col("kept").getField(text_col).alias("text"))
    classes = simhash_classes(spark, inner, "id", "text", shingle, max_bits, row=F.col("row"))
    first = classes.where("doc = component").groupBy("root").agg(F.min("row").alias("row")).select("row")
    return numbered.join(first, "row", "left_semi").select(*[F.col("kept").getField(c).alias(c) for c in names])


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_classes(spark, docs).select(
        from_key("doc").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        from_key("component").alias("component_id"))
