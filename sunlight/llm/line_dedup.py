"""Line deduplication through a sharded minimal perfect hash.

Every line key becomes a 128-bit hash. The distinct hashes that occur in two
or more documents are dealt to shards; each shard is one row of binary
arrays: the levels of a minimal perfect hash, and, at the slot it gives,
a 64-bit fingerprint, the document count and the id of the keeping document.
Documents probe these arrays with the hashes of their lines: line hashes travel to
the shards, line texts never do. The verdicts (the hashes of the lines that a document
loses) come back by a join on the document, for which each text is shuffled
once. A shard whose lines occur very often (a hot license
line) is copied to as many salts as its load needs, so a task's load is
bounded by ``PROBES_PER_TASK`` on average and no group grows with a key.
A Python worker takes its texts apart in slices of ``SLICE_BYTES``, so beside Spark's
batch it holds the lines of one slice (a longer text is a slice of its own).

Keys differ from each other but for 128-bit hash collisions; a foreign line
that reaches a slot is told apart by the fingerprint.

Defined cases: a null or empty text is one empty line. A null doc_id is
ordered after all others, and each row without one is a document of its own.
Rows with the same doc_id are one document for counting, and each row keeps
its own lines. A text that loses all its lines
becomes the empty text. An empty table gives an empty result. Other columns
pass through unchanged, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import doc_key, stash, table

MIN_KEY = 10
KEYS_PER_SHARD = 1 << 16
PROBES_PER_TASK = 1 << 18
SLICE_BYTES = 4 << 20
STRIP = " \t\n\x0b\x0c\r"
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def line_hash(line: str, min_key: int = MIN_KEY) -> bytes | None:
    """128-bit hash of a line's key; None for a key that is too short."""
    key = line.strip(STRIP)
    if len(key) < min_key:
        return None
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())


def slices(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """All rows of ``batches`` in order, in parts of about ``size`` bytes by a batch's mean row, of one row at least."""
    for b in batches:
        step = max(1, b.num_rows * size // max(1, b.nbytes))
        for at in range(0, b.num_rows, step):
            yield b.slice(at, step)


# -- minimal perfect hash -------------------------------------------------

def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Slot on a level of each key, a row of two 64-bit words."""
    with np.errstate(over="ignore"):
        x = keys[:, 0] + keys[:, 1] * (_MIX[0] * np.uint64(2 * level + 1))
        x = (x ^ (x >> np.uint64(30))) * _MIX[1]
        x = (x ^ (x >> np.uint64(27))) * _MIX[2]
        x ^= x >> np.uint64(31)
    return (x % np.uint64(size)).astype(np.int64)


def build_mph(keys: np.ndarray) -> list[np.ndarray]:
    """Levels of bits: on each, the slots that exactly one remaining key takes."""
    levels, left = [], keys
    while len(left):
        size = 2 * len(left)
        at = _place(left, len(levels), size)
        alone = np.bincount(at, minlength=size) == 1
        levels.append(alone)
        left = left[~alone[at]]
    return levels


def lookup_mph(levels: list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Slot 0..n-1 of each key (any slot, or -1, for a key not built in)."""
    out = np.full(len(keys), -1, dtype=np.int64)
    todo, base = np.arange(len(keys)), 0
    for n, bits in enumerate(levels):
        at = _place(keys[todo], n, len(bits))
        hit = bits[at]
        rank = np.cumsum(bits)
        out[todo[hit]] = base + rank[at[hit]] - 1
        base += int(rank[-1])
        todo = todo[~hit]
    return out


INDEX_SCHEMA = ("shard int, level_sizes array<int>, level_bits binary, fingerprint binary, "
                "documents binary, keeper binary, keeper_row binary")


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    keys = np.ascontiguousarray(rows[["h1", "h2"]].to_numpy(np.int64)).view(np.uint64)
    levels = build_mph(keys)
    slot = lookup_mph(levels, keys)
    order = np.empty(len(keys), dtype=np.int64)
    order[slot] = np.arange(len(keys))
    return pd.DataFrame({
        "shard": [key[0]],
        "level_sizes": [np.array([len(x) for x in levels], dtype=np.int32)],
        "level_bits": [b"".join(np.packbits(x).tobytes() for x in levels)],
        "fingerprint": [keys[order, 1].astype("<u8").tobytes()],
        "documents": [rows["documents"].to_numpy(np.int64)[order].astype("<i8").tobytes()],
        "keeper": [rows["keeper"].to_numpy(np.int64)[order].astype("<i8").tobytes()],
        "keeper_row": [rows["keeper_row"].to_numpy(np.int64)[order].astype("<i8").tobytes()]})


def _probe(key: tuple, lines: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Lines of one shard (and salt) that their document loses."""
    if not len(lines) or not len(index):
        return pd.DataFrame({"doc": pd.Series(dtype="int64"), "row": pd.Series(dtype="int64"),
                             "line": pd.Series(dtype="object")})
    shard = index.iloc[0]
    levels, at = [], 0
    for size in shard["level_sizes"]:
        packed = np.frombuffer(shard["level_bits"], np.uint8, (size + 7) // 8, at)
        levels.append(np.unpackbits(packed, count=size).astype(bool))
        at += len(packed)
    keys = np.ascontiguousarray(lines[["h1", "h2"]].to_numpy(np.int64)).view(np.uint64)
    slot = lookup_mph(levels, keys)
    known = slot >= 0
    known[known] = np.frombuffer(shard["fingerprint"], "<u8")[slot[known]] == keys[known, 1]
    doc, row = lines["doc"].to_numpy(np.int64), lines["row"].to_numpy(np.int64)
    lost = known.copy()
    lost[known] = (np.frombuffer(shard["keeper"], "<i8")[slot[known]] != doc[known]) | \
        (np.frombuffer(shard["keeper_row"], "<i8")[slot[known]] != row[known])
    return pd.DataFrame({"doc": doc[lost], "row": row[lost], "line": [x.tobytes() for x in keys[lost].astype("<u8")]})


# -- the operator ---------------------------------------------------------

def with_rows(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, rest, text): row is 0, or a positive number of its own for a row without id, fixed by a write."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    missing = F.col(id_col).cast("long").isNull()
    keyed = lambda df, row: df.select(doc_key(id_col).alias("doc"), row.alias("row"), rest, text)
    own = stash(spark, keyed(docs.where(missing), F.monotonically_increasing_id() + 1), "line-no-id")
    return keyed(docs.where(~missing), F.lit(0).cast("long")).unionAll(own)


def line_hashes(keyed: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """Distinct (doc, row, h1, h2) of the long enough line keys of each row."""
    size = SLICE_BYTES

    def run(batches):
        for b in slices(batches, size):
            ids, rows, found = [], [], []
            for doc, row, text in zip(*(b.column(c).to_pylist() for c in range(3))):
                own = {h for line in text.split("\n") if (h := line_hash(line, min_key))} if text else ()
                found.extend(own)
                ids.extend([doc] * len(own))
                rows.extend([row] * len(own))
            both = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1])],
                names=["doc", "row", "h1", "h2"])
    return keyed.select("doc", "row", "text").mapInArrow(run, "doc long, row long, h1 long, h2 long")


def build_index(spark: SparkSession, lines: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(index shards with a ``salt`` column, salts per shard, shard count) of stashed ``lines``."""
    # Rows without id come last and alone have a row over 0: the least doc and the least row are one document's.
    repeated = stash(spark, lines.groupBy("h1", "h2").agg(
        F.min("doc").alias("keeper"), F.max("doc").alias("last"),
        F.min("row").alias("keeper_row"), F.max("row").alias("last_row"),
        F.count(F.lit(1)).alias("documents")).where("keeper <> last OR keeper_row <> last_row")
        .drop("last", "last_row"), "line-repeated")
    shards = max(1, math.ceil(repeated.count() / KEYS_PER_SHARD), math.ceil(lines.count() / PROBES_PER_TASK))
    shard = F.pmod(F.col("h2"), F.lit(shards)).cast("int").alias("shard")
    index = stash(spark, repeated.select("*", shard).groupBy("shard")
                  .applyInPandas(_build_shard, INDEX_SCHEMA), "line-index")
    # Occurrences beyond the first make a shard heavier than the even share.
    load = repeated.groupBy(shard).agg(
        (1 + F.floor(F.sum("documents") / PROBES_PER_TASK)).cast("int").alias("salts"))
    copies = index.join(load, "shard").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return copies, load, shards


def line_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_key: int = MIN_KEY, report: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with the remaining text in ``text_col`` and two columns named by
    ``report`` after them: lines before, and lines dropped."""
    keyed = with_rows(spark, docs, id_col, text_col)
    lines = stash(spark, line_hashes(keyed, min_key), "line-hashes")
    index, load, shards = build_index(spark, lines)
    dealt = (lines.withColumn("shard", F.pmod("h2", F.lit(shards)).cast("int"))
             .join(load, "shard")
             .withColumn("salt", F.pmod(F.xxhash64("doc", "row", "h1"), F.col("salts")).cast("int")).drop("salts"))
    lost = (dealt.groupBy("shard", "salt").cogroup(index.groupBy("shard", "salt"))
            .applyInPandas(_probe, "doc long, row long, line binary")
            .groupBy("doc", "row").agg(F.collect_list("line").alias("lost")))

    names, size = docs.columns, SLICE_BYTES
    both = keyed.join(lost, ["doc", "row"], "left").select(F.col("rest").alias("row"), "text", "lost")

    def cut(batches):
        for b in slices(batches, size):
            texts, n_lines, n_lost = [], [], []
            for text, gone in zip(b.column("text").to_pylist(), b.column("lost").to_pylist()):
                if not gone:
                    texts.append(text)
                    n_lines.append(text.count("\n") + 1)
                    n_lost.append(0)
                    continue
                all_lines, gone = text.split("\n"), set(gone)
                kept = [x for x in all_lines if line_hash(x, min_key) not in gone]
                texts.append("\n".join(kept))
                n_lines.append(len(all_lines))
                n_lost.append(len(all_lines) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_lost, pa.int64())], names=["row", "text", "a", "b"])

    schema = T.StructType([both.schema["row"], T.StructField("text", T.StringType()),
                           T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    done = both.mapInArrow(cut, schema)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                         for c in names],
                       F.col("a").alias(report[0]), F.col("b").alias(report[1]))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(spark, docs).select("doc_id", "n_lines", "n_dropped",
                                          F.sha2(F.col("text"), 256).alias("kept_sha256"))


OP8_SQL = """
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM cut),
keyed AS (SELECT doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
repeated AS (SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
    GROUP BY k HAVING min(doc_id) <> max(doc_id)),
judged AS (SELECT x.doc_id, x.pos, x.line, r.keeper IS NOT NULL AND r.keeper <> x.doc_id AS gone
    FROM keyed x LEFT JOIN repeated r ON x.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
