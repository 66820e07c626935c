import itertools
import re

import numpy as np
import pytest
import xxhash

from sunlight.llm import simhash as S
from sunlight.llm.components import connected_components

SMALL = "/root/testdata/sf0.001"


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_classes(values):
    """Least index reachable by links of at most four bits."""
    v, root = np.array(values, dtype=np.uint64), list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(v)):
        for j in (np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= 4) + i + 1).tolist():
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


def test_query_equals_brute_force(spark, small_docs):
    rows = sorted(small_docs)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = {rows[i][0]: (f"{fps[i]:016x}", rows[r][0]) for i, r in enumerate(brute_classes(fps))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in S.op5_simhash_near_dedup(spark, SMALL).collect()}
    assert got == want


def test_fingerprint_equals_brute_force(edge_rows):
    for _, t in edge_rows:
        t = t[:20_000] if t else t
        assert S.fingerprint(t) == brute_fingerprint(t)


@pytest.mark.parametrize("shared", [4, 5, 6, 7, 8])
def test_posted_positions_cover(shared):
    for size in range(1, shared + 1):
        posted = [set(p) for p in S.posted_positions(size, shared)]
        assert all(any(p <= set(c) for p in posted) for c in itertools.combinations(range(8), shared))
    assert len(S.posted_positions(2, 4)) == 7 and len(S.posted_positions(3, 4)) == 20


@pytest.mark.parametrize("rows, block", [(100, 1 << 15), (100_000, 1 << 15), (10_000_000, 1 << 15), (100_000, 40)])
def test_links_give_the_brute_force_classes(spark, rows, block):
    """Background, a chain, and dense clusters, for every posting size and for lists cut in blocks."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 64, 60, dtype=np.uint64)
    flip = lambda x, n: x ^ np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, n, replace=False).astype(np.uint64))
    near = [flip(b, int(rng.integers(1, 7))) for b in base[:6] for _ in range(60)]
    chain = [base[10]]
    for _ in range(25):
        chain.append(flip(chain[-1], 4))
    values = np.unique(np.concatenate([base, np.array(near, np.uint64), np.array(chain, np.uint64)]))
    want = brute_classes(values.tolist())
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    links = S.near_links(spark, fps, rows, block=block)
    roots = {r["node"]: r["root"] for r in connected_components(spark, links).collect()}
    got = [roots.get(int(v), int(v)) for v in values.view(np.int64)]
    pairs = lambda labels: sorted(tuple(sorted(i for i, x in enumerate(labels) if x == k)) for k in set(labels))
    assert pairs(got) == pairs(want)
    for r in links.collect():
        assert bin((r["a"] ^ r["b"]) & (2 ** 64 - 1)).count("1") <= 4


def test_dedup_edges(spark, edge_docs, no_docs):
    got = S.simhash_dedup(spark, edge_docs)
    assert got.columns == edge_docs.columns
    # null, empty and blank texts share fingerprint zero; equal texts are one class; a null id comes last
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 4, 6, 7, 8, 9]
    assert S.simhash_dedup(spark, no_docs).count() == 0
    classes = S.simhash_classes(spark, edge_docs)
    assert classes.count() == edge_docs.count()


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["node"]: r["root"] for r in connected_components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[k] == 100 for k in range(100, 160)) and got[300] == 299
    assert len(got) == 41 + 60 + 2
