import hashlib
import string
import tracemalloc
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sunlight.llm import exact_dedup as X, line_dedup as L

SMALL = "/root/testdata/sf0.001"


def duck(sql):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(names)
    return sorted(tuple(dict(zip(names, r))[c] for c in order) for r in cur.fetchall())


def spark_rows(df):
    return sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


@pytest.mark.parametrize("query, sql", [(X.op10_exact_dedup, X.OP10_SQL), (L.op8_line_dedup, L.OP8_SQL)])
def test_equals_sql(spark, query, sql):
    assert spark_rows(query(spark, SMALL)) == duck(sql)


@pytest.mark.parametrize("max_bits", [X.MAX_BITS, X.SEGMENT_BITS])
def test_exact_edges(spark, edge_docs, edge_rows, max_bits):
    got = X.exact_dedup(spark, edge_docs, max_bits=max_bits).collect()
    assert len(got) == len(edge_rows)
    groups = defaultdict(list)
    for i, t in edge_rows:
        groups[hashlib.sha256((t or "").encode()).digest()].append(i)
    for r in got:
        ids = groups[bytes(r["sha"])]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(groups)                       # exactly one row of each group, repeated ids too
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_exact_filter_has_no_false_negative():
    digests = [hashlib.sha256(str(i % 900).encode()).digest() for i in range(1000)]
    bits = X.SEGMENT_BITS
    import pandas as pd
    parts = [p for lo in range(0, 1000, 250)
             for p in X._partial_filters(bits)(iter([pd.DataFrame({"sha": digests[lo:lo + 250]})]))]
    merged = X._merge_segment((0,), pd.concat(parts))
    bitmap = np.frombuffer(merged["bits"][0], np.uint8)
    slots = X._slots(digests, bits)
    maybe = ((bitmap[slots >> 3] >> (slots & 7)) & 1).all(axis=1)
    again = np.array([digests.count(d) > 1 for d in digests])
    assert maybe[again].all()
    assert maybe[~again].mean() < 0.1


def test_exact_dedup_in_slices(spark):
    """More rows than one filter holds: several filters, the same result, few single rows passing."""
    rows = [(i, f"text {i % 9000}" if i % 3 else "one text") for i in range(15_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert X.slice_count(len(rows), max_bits=X.SEGMENT_BITS) == 4
    got = X.exact_dedup(spark, docs, max_bits=X.SEGMENT_BITS)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t].append(i)
    want = sorted((i, max(groups[t]), len(groups[t]), i == max(groups[t])) for i, t in rows)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got.collect()) == want
    hashed = docs.selectExpr("doc_id", "unhex(sha2(text, 256)) AS sha", "doc_id AS row_id")
    marked = X._marked_by_slice(spark, hashed, X.SEGMENT_BITS, 4)
    passed = marked.where("maybe").count()
    repeated = sum(len(g) for g in groups.values() if len(g) > 1)
    assert repeated <= passed <= repeated + 0.1 * (len(rows) - repeated)


def test_exact_filter_is_bounded():
    assert X.slice_count(16_000_000) == 1 and X.slice_count(10 ** 9) == 60
    assert X.filter_bits(10 ** 12) == X.MAX_BITS
    assert X.filter_bits(0) == X.SEGMENT_BITS


def brute_lines(rows, min_key=10):
    key = lambda s: "".join(c.lower() if c in string.ascii_uppercase else c for c in s.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: float("inf") if i is None else i
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_key:
                holders[key(line)].add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != order(i))]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_edges(spark, edge_rows):
    rows = edge_rows + [(20, "License text, Version 2\nown line of document twenty"),
                        (21, "  LICENSE text, version 2 \nLICENSE text, version 2\nshort"), (22, "short\nlicense TEXT, version 2")]
    docs = spark.createDataFrame([(i, t, 7, "z") for i, t in rows], "doc_id long, text string, n_lines int, lost string")
    got = L.line_dedup(spark, docs, report=("before", "gone"))
    assert got.columns == ["doc_id", "text", "n_lines", "lost", "before", "gone"]
    assert sorted([(r["doc_id"], r["text"], r["before"], r["gone"]) for r in got.collect()], key=str) == brute_lines(rows)


def test_lines_hot_shard_is_salted(spark, monkeypatch):
    monkeypatch.setattr(L, "PROBES_PER_TASK", 50)
    monkeypatch.setattr(L, "KEYS_PER_SHARD", 8)
    rows = [(i, f"a line that every document has\nown line {i % 30} of some documents\n{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = L.line_dedup(spark, docs)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_lines(rows)


def test_lines_in_slices(spark, edge_rows, monkeypatch):
    """Parts of a few rows, or one: every row comes out once, with its own lines."""
    monkeypatch.setattr(L, "SLICE_BYTES", 100)
    rows = edge_rows + [(i, f"a line that every document has\n{i % 7} is a line of some\n{i}") for i in range(100, 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted([tuple(r) for r in L.line_dedup(spark, docs).collect()], key=str) == brute_lines(rows)


def test_lines_worker_holds_a_slice_of_its_batch(spark, monkeypatch):
    """Python objects of a worker stay below a batch of long texts, in both functions that take texts apart."""
    docs = spark.createDataFrame([(1, "one")], "doc_id long, text string")
    sent, real = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda df, f, *a, **k: sent.append(f) or real(df, f, *a, **k))
    L.line_dedup(spark, docs)
    hashes, cut = sent
    texts = ["\n".join(f"line {i} of text {j}, some sixty characters long as lines often are" for i in range(2000))
             for j in range(200)]
    ids = pa.array(range(200), pa.int64())
    batch = lambda names, *columns: pa.RecordBatch.from_arrays([*columns], names=names)
    lost = [[L.line_hash(t[:t.index("\n")])] for t in texts]
    keyed = batch(["doc", "row", "text"], ids, pa.array([0] * 200, pa.int64()), pa.array(texts))
    judged = batch(["row", "text", "lost"], pa.StructArray.from_arrays([ids], names=["doc_id"]), pa.array(texts),
                   pa.array(lost, pa.list_(pa.binary())))

    def peak(run, given):
        rows = 0
        tracemalloc.start()
        for out in run(iter([given])):
            rows += out.num_rows
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return rows, most

    rows, most = peak(hashes, keyed)
    assert rows == 200 * 2000 and most < keyed.nbytes
    rows, most = peak(cut, judged)
    assert rows == 200 and most < judged.nbytes
    done = pa.Table.from_batches(cut(iter([judged])))
    assert done["row"].combine_chunks().field("doc_id").to_pylist() == list(range(200))
    assert done["text"].to_pylist() == [t[t.index("\n") + 1:] for t in texts]
    assert done["a"].to_pylist() == [2000] * 200 and done["b"].to_pylist() == [1] * 200


def test_minimal_perfect_hash():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2 ** 63, size=(5000, 2), dtype=np.uint64)
    levels = L.build_mph(keys)
    assert sorted(L.lookup_mph(levels, keys).tolist()) == list(range(5000))


def test_empty(spark, no_docs):
    assert X.exact_dedup(spark, no_docs).count() == 0
    assert L.line_dedup(spark, no_docs).count() == 0
