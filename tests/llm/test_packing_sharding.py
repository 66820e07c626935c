import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from sunlight.llm import packing as P, sharding as H

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(P.production_tokenizer())


def pieces_of(tokenizer, rows):
    out = []
    for i, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at:at + 4096]
            out.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    return sorted(out, key=str)


def check_packed(got):
    """Sequences are gapless from 0 and hold at most 4096; few are needed."""
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    return len(by)


def test_query_equals_whole_text_encoding(spark, small_docs, tokenizer):
    got = P.op4_best_fit_packing(spark, SMALL).collect()
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=str) \
        == pieces_of(tokenizer, small_docs)
    total = sum(r["length"] for r in got)
    assert check_packed(got) <= -(-total // 4096) + 1


def test_edges(spark, edge_docs, edge_rows, no_docs, tokenizer):
    got = P.pack_documents(spark, edge_docs, P.production_tokenizer()).collect()
    assert sorted([(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got], key=str) \
        == pieces_of(tokenizer, edge_rows)
    check_packed(got)
    assert P.pack_documents(spark, no_docs, P.production_tokenizer()).count() == 0


def test_word_cache_equals_whole_text_encoding(tokenizer):
    """Random texts of awkward characters, through the cache and as whole texts."""
    rng = random.Random(4)
    alphabet = list("abcXYZ019'’.,!?#$*()-_\"<>|/\\ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　éÉßñÑêÀøÿµªº²½ΣςİıŁ日本🙂́İǅ") \
        + ["'s", "'ll", "it's", "IT'S", "<|endoftext|>", "<|startoftext|>", "word", "Wört,", "naïve."]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(1500)]
    encoder = P.WordEncoder(open(P.production_tokenizer(), encoding="utf-8").read())
    import pyarrow as pa
    for lo in range(0, len(texts), 100):
        part = texts[lo:lo + 100]
        ids, offsets = encoder.encode(pa.array(part))
        for i, t in enumerate(part):
            assert ids[offsets[i]:offsets[i + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_best_fit_equals_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(20):
        lengths = rng.integers(1, 101, size=rng.integers(1, 200))
        sequence, offset = P.best_fit_decreasing(lengths, 100)
        rooms, want = [], []
        for i in np.argsort(-lengths, kind="stable"):
            fits = [r for r in rooms if r >= lengths[i]]
            if fits:
                rooms[rooms.index(min(fits))] -= lengths[i]
            else:
                rooms.append(100 - lengths[i])
        used = np.zeros(sequence.max() + 1, int)
        np.add.at(used, sequence, lengths)
        assert sorted(100 - used) == sorted(rooms)       # the tightest sequence every time
        assert (used <= 100).all()


def test_packed_sequences_hold_the_ids(spark, small_docs, tokenizer):
    docs = spark.createDataFrame(small_docs[:60], "doc_id long, text string")
    packed = P.best_fit_pack(spark, P.tokenized_pieces(spark, docs, P.production_tokenizer(), keep_ids=True))
    sequences = {r["sequence_id"]: r["ids"] for r in P.packed_sequences(packed).collect()}
    for r in packed.collect():
        part = sequences[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]


def check_shards(rows, got, shards=16):
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    sizes = [sum(r["size"] for r in by[s]) for s in range(shards)]
    total, largest = sum(sizes), max(r["size"] for r in got)
    for s in range(shards):
        assert sorted(r["slot"] for r in by[s]) == list(range(len(by[s])))
        assert abs(sizes[s] - total / shards) <= largest
    return sizes


def test_shards_of_the_query(spark, small_docs):
    got = H.op6_sampled_splitters(spark, SMALL).collect()
    check_shards(small_docs, got)
    assert {r["law"] for r in got} == {"bytes"} and all(r["grown_shard"] is None for r in got)


def test_shards_with_a_hot_text_and_edges(spark, edge_docs, no_docs):
    rows = [(i, f"text {i} " * (1 + i % 9)) for i in range(4000)] + [(4000 + i, "the same text for a third") for i in range(2000)] \
        + [(None, None)] * 50 + [(9000, "")] * 50
    got = H.shard_by_bytes(spark, spark.createDataFrame(rows, "doc_id long, text string"), ranges=64).collect()
    check_shards(rows, got)
    assert len(got) == len(rows)
    assert H.shard_by_bytes(spark, no_docs).count() == 0
    assert H.shard_by_bytes(spark, edge_docs).count() == edge_docs.count()


def test_ranges_overfull_with_small_rows_are_subdivided(spark):
    """A third of the rows without text is a sliver of the bytes: it is divided by rows all the same."""
    from pyspark.sql import functions as F
    n = 60_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.repeat(F.lit("text "), F.lit(20)))
                                 .alias("base")).select("doc_id", F.concat("base", F.col("doc_id").cast("string")).alias("text"))
    records = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                          F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.col("doc_id").alias("doc"), F.col("doc_id").alias("row_id"))
    total = records.agg(F.sum("size")).first()[0]
    rows = lambda s: sorted(r["count"] for r in records.groupBy(H._searched(s).alias("r")).count().collect())
    first = H.sample_splitters(records, total, 64)
    assert rows(first)[-1] >= n // 3
    more = H.subdivide(records, first, n, 64)
    even = -(-n // 64)
    assert rows(more)[-1] <= 4 * even and len(more) <= 128
    got = H.shard_by_bytes(spark, docs).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert len(got) == n
    assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in by.values())
    assert max(abs(sum(r["size"] for r in rs) - total / 16) for rs in by.values()) <= 2 * 130
