import hashlib
import math
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sunlight.llm import fill_in_middle as M, lexical_search as S, url_filter as U

SMALL = "/root/testdata/sf0.001"


def duck(sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t)}.parquet')")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted((tuple(dict(zip(names, r))[c] for c in sorted(names)) for r in cur.fetchall()), key=str)


@pytest.mark.parametrize("query, sql", [(M.op11_fill_in_middle, M.OP11_SQL), (S.op12_lexical_search, S.OP12_SQL),
                                        (U.op13_url_filter, U.OP13_SQL)])
def test_equals_sql(spark, query, sql):
    df = query(spark, SMALL)
    assert sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str) == duck(sql)


# -- fill in the middle -----------------------------------------------------

def test_skip_list_reaches_every_rank():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 4, 5, 17, 400):
        widths = rng.integers(1, 90, n)
        index = M.SkipList(widths)
        assert [index.points_before(r) for r in range(n + 1)] == np.r_[0, np.cumsum(widths)].tolist()
        for units, points, _ in index.lanes:                   # every lane spans the whole text
            assert units.sum() == n and points.sum() == widths.sum()
    lanes = M.SkipList(rng.integers(1, 9, 100_000)).lanes
    assert len(lanes) < 20 and len(lanes[1][0]) < 40_000


def brute_fim(doc, text, seed=7, sentinels=("<P>", "<S>", "<M>"), pattern=r"[^\n]*\n|[^\n]+", rate=100, spm=50):
    text = text or ""
    units = [m.group() for m in re.finditer(pattern, text)]
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    p, s, m = sentinels
    if not text or any(x in text for x in sentinels) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle
    return n, "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle


ODD_TEXTS = ["\n", "\n\n\n", "a\n\nb", "ends\n", "no end", "has <S> inside\nand more", "<", "<P\n>", "\r\nx\r\n", "é\U0001F600\nü\n" * 40,
             "\n".join(str(i) for i in range(3000))]


@pytest.mark.parametrize("sentinels, pattern, rate", [
    (M.SENTINELS, M.LINES, 100), (("\u0001a", "\u0001b", "\u0001c"), r"\s*\S+\s*|\s+", 60)])
def test_fill_in_middle_equals_brute_force(spark, edge_rows, sentinels, pattern, rate):
    rows = edge_rows + [(100 + i, t) for i, t in enumerate(ODD_TEXTS * 5)]
    docs = spark.createDataFrame([(i, t, 5, "f", None) for i, t in rows], "doc_id long, text string, n int, form string, page string")
    names = ("units", "shape", "before", "inside", "made")
    got = M.fill_in_middle(spark, docs, sentinels=sentinels, pattern=pattern, rate=rate, names=names)
    assert got.columns == [*docs.columns, *names]
    got = got.withColumn("back", M.restored(F.col("made"), F.col("shape"), sentinels)).collect()
    assert sorted([(r["doc_id"], r["text"], *(r[c] for c in names)) for r in got], key=str) == sorted(
        [(i, t, *brute_fim(i, t, sentinels=sentinels, pattern=pattern, rate=rate)) for i, t in rows], key=str)
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {r["shape"] for r in got} == {"plain", "psm", "spm"}
    assert all((r["n"], r["form"], r["page"]) == (5, "f", None) for r in got)


def test_fill_in_middle_slices_and_empty(spark, no_docs, monkeypatch):
    assert M.fill_in_middle(spark, no_docs).count() == 0
    monkeypatch.setattr(M, "SLICE_BYTES", 10)
    docs = spark.createDataFrame([(i, "one\ntwo\n" * (i % 7)) for i in range(200)], "doc_id long, text string")
    got = {r["doc_id"]: r["output"] for r in M.fill_in_middle(spark, docs).collect()}
    assert got == {i: brute_fim(i, "one\ntwo\n" * (i % 7))[4] for i in range(200)}


@pytest.mark.parametrize("bad", [("<P>", "<P>", "<M>"), ("ab", "ba", "c"), ("<P>", "<P>x", "<M>"), ("", "a", "b"), ("aa", "b", "c")])
def test_overlapping_sentinels_are_refused(bad):
    with pytest.raises(ValueError):
        M.check_sentinels(bad)


def test_units_must_cover_the_text():
    with pytest.raises(ValueError):
        M.unit_widths("a b", r"\S+")


# -- ranked search ----------------------------------------------------------

def brute_search(docs, items, k=20):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                                 "".join(c.lower() if c.isascii() else c for c in t or ""))
    bags = [(i, place, Counter(terms(t))) for place, (i, t) in enumerate(docs) if terms(t)]
    n_docs, length = len(bags), sum(sum(b.values()) for _, _, b in bags)
    df = Counter(t for _, _, b in bags for t in b)
    out = []
    for item, text in set(items):
        asked = Counter(terms(text))
        scored = []
        for doc, place, bag in bags:
            m = 75 + 25 * sum(bag.values()) * n_docs // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * bag[t] // (1000 * bag[t] + 12 * m)) for t, q in asked.items() if t in bag)
            if score > 0:
                scored.append((-score, float("inf") if doc is None else doc, place))
        for rank, (score, doc, _) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if doc == float("inf") else doc, -score))
    return sorted(out, key=str)


def words(rng, n, vocabulary=300):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("k, owners, block, bundle, part", [(20, 4, 4096, 256, 4096), (3, 3, 16, 4, 4096), (5, 1, 7, 256, 6),
                                                             (1, 6, 40, 3, 4096)])
def test_search_equals_brute_force(spark, monkeypatch, k, owners, block, bundle, part):
    monkeypatch.setattr(S, "BLOCK_DOCS", block)
    monkeypatch.setattr(S, "BUNDLE_ITEMS", bundle)
    monkeypatch.setattr(S, "PART_ITEMS", part)
    rng = random.Random(11)
    docs = [(i, words(rng, rng.randint(0, 60))) for i in range(300)]
    docs += [(400 + i, docs[i % 5][1]) for i in range(60)]      # ties: many copies
    docs += [(900, None), (901, ""), (902, " .;: "), (903, "W1 w2-w3_W4 É é w1"), (904, "x" * 5000 + " w7 " * 3000)]
    items = [(i, words(rng, rng.randint(1, 25))) for i in range(12)]
    items += [(50, None), (51, "!!"), (52, "unknownterm"), (53, "É w7 w7 W7"), (3, "w2 other text of item three"), items[0]]
    got = S.rank_documents(spark, spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double"),
                           spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int").repartition(3), k=k, owners=owners)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_search(docs, items, k)


def test_search_edges(spark, no_docs, edge_docs, edge_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "same words of everyone"), (2, "lines again")], "item_id long, text string")
    assert S.rank_documents(spark, no_docs, some).count() == 0
    assert S.rank_documents(spark, edge_docs, none).count() == 0
    got = S.rank_documents(spark, edge_docs, some)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_search(
        edge_rows, [(1, "same words of everyone"), (2, "lines again")])


def test_terms_are_dealt_rarest_first():
    df = np.array([100, 1, 50, 2, 3, 0, 44])
    owner = S.deal_terms(df, 2)
    assert owner[0] == 1 and (owner[[1, 3, 4, 5, 6, 2]] == 0).all()
    assert S.deal_terms(np.zeros(3, np.int64), 4).min() >= 0


# -- URL filter -------------------------------------------------------------

def brute_urls(url, rules, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    return host, path, None, "block" if U.canonical(url) in listed and host else "allow"


URLS = [None, "", "no scheme", "http://", "http://org", "http://ORG/", "HTTPS://Sub.Example.ORG/es/1?x#y", "http://example.org/en/12",
        "http://example.org/en/2", "http://xexample.org/es/", "a://b.com/fr/://c.org/", "http://b.com/de", "http://b.com/de/",
        "http://example.net/a/?utm_source=q&b=2&a=1", "https://www.example.net/a?a=1&b=2#z", "http://example.net:80/a?b=2&a=1",
        "http://user@bad.net/x/", "http://bad.net/x", "http://bad.net/x/y", "http://bad.net#/x", "http://..org/", "http://org./",
        "http://É.example.org/es/", "http://" + "a." * 4000 + "org/es/", "http://h.net/" + "p/" * 30000, "http://a.b.net/ab", "x://a.b.net/ac"]


@pytest.mark.parametrize("most_broadcast, rows", [(U.MOST_BROADCAST, U.BROADCAST_ROWS), (0, 0)])
def test_urls_equal_brute_force(spark, monkeypatch, most_broadcast, rows):
    monkeypatch.setattr(U, "BROADCAST_ROWS", rows)
    monkeypatch.setattr(U, "BLOCKS_PER_SHARD", 4)
    rng = random.Random(3)
    host = lambda: ".".join(rng.choice(["a", "b", "example", "www"]) for _ in range(rng.randint(0, 2))) + "." + rng.choice(["org", "com", "net", "example.org"])
    made = [f"http://{host().lstrip('.')}/{rng.choice(['es', 'en', 'fr', 'de'])}/{rng.randint(0, 30)}{rng.choice(['', '/', '#t', '?utm_source=f', '?page=2'])}" for _ in range(400)]
    urls = URLS + made + made[:50]
    bad = ["http://example.net/a?a=1&b=2", "https://www.bad.net/x", None, "junk", *made[100:200:3]]
    rules = [*U.RULES, ("net", "/ab", "block"), ("b.net", "/a", "allow"), ("", "/", "block"), ("org", "/", "allow")]
    pages = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, n int")
    got = U.judge_urls(spark, pages, U.rule_table(spark, rules), spark.createDataFrame([(u,) for u in bad], "url string"),
                       most_broadcast=most_broadcast, names=("h", "p", "rule", "verdict"))
    assert got.columns == ["page_id", "url", "host", "n", "h", "p", "rule", "verdict"]
    listed = {U.canonical(u) for u in bad} - {None}
    assert sorted([(r["page_id"], r["h"], r["p"], r["rule"], r["verdict"]) for r in got.collect()]) == [
        (i, *brute_urls(u, rules, listed)) for i, u in enumerate(urls)]


def test_urls_without_list_or_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, None)], "page_id long, url string")
    no_rules = U.rule_table(spark).where("false")
    got = U.judge_urls(spark, pages, no_rules, pages.select("url").where("false")).collect()
    assert sorted((r["page_id"], r["rule"], r["verdict"]) for r in got) == [(1, None, "allow"), (2, None, "allow")]
    assert U.judge_urls(spark, pages.where("false"), U.rule_table(spark), pages.select("url")).count() == 0


def test_blocked_filter_has_no_false_negative_and_few_false_positives():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2 ** 63, 60_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    blocks = U.block_count(20_000)
    words = U.fill(h[:20_000], U.blocks_of(h[:20_000], blocks), blocks)
    found = U.holds(words, h, U.blocks_of(h, blocks))
    assert found[:20_000].all()
    assert found[20_000:].mean() < 0.01


def test_canonical_urls():
    same = ["http://www.A.com/x/", "https://a.com/x?utm_medium=b#c", "a://u:p@a.com:8080/x?ref=z", "http://a.com./x"]
    assert {U.canonical(u) for u in same} == {"a.com/x"}
    assert U.canonical("http://a.com/x?b=1&a=2") == "a.com/x?a=2&b=1"
    assert U.canonical("http:///x") is None
