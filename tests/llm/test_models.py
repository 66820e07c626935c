import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from sunlight.llm import embedding_dedup as E, language_id as L, mixing as M

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# -- language identification -------------------------------------------------

def test_languages_of_the_held_out_fifth(spark):
    got = {r["doc_id"]: r for r in L.op9_language_id(spark, MID).collect()}
    t = pq.read_table(f"{MID}/documents.parquet", columns=["doc_id", "lang"]).to_pydict()
    import zlib
    held = {i for i in t["doc_id"] if zlib.crc32(str(i).encode()) % 5 == 0}
    assert {i for i, r in got.items() if r["held_out"]} == held
    right = [got[i]["lang_pred"] == lang for i, lang in zip(t["doc_id"], t["lang"]) if i in held]
    assert np.mean(right) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_prediction_does_not_see_the_label(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = L.fit(spark, docs)
    from pyspark.sql import functions as F
    hidden = docs.select("doc_id", "text", F.lit("xx").alias("lang"))
    a = {r["doc_id"]: r["lang_pred"] for r in L.identify(spark, docs.select("doc_id", "text"), model).collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in L.identify(spark, hidden, model).collect()}
    assert a == b


def test_margins_equal_the_feature_matrix(edge_rows):
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(L.BUCKETS, 3)).astype(np.float32)
    texts = [t for _, t in edge_rows if t] + ["", "a", "ab", "abc", "1 2 3", "  x  ", "ÀÉ îõ ñ! ñ?", "日本語 text"]
    want = L.features(texts).astype(np.float64) @ weights + np.array([0.5, 0, -1])
    assert L.margins(texts, weights, np.array([0.5, 0, -1])) == pytest.approx(want, abs=1e-4)


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 20))
    y = np.where(x[:, 0] + 0.5 * x[:, 3] > 0.8, 1.0, -1.0)
    w, b = L.fit_svm(x, y)
    assert np.mean(np.sign(x @ w + b) == y) > 0.93


def test_sparse_rows_fit_like_dense_ones():
    rng = np.random.default_rng(3)
    x = np.where(rng.random((1100, 60)) < 0.2, rng.random((1100, 60)), 0).astype(np.float16)
    x[[0, 5, 512, 1099]] = 0                                 # texts too short to have a gram
    y = np.where(x[:, 0] + x[:, 1] > x[:, 2], 1.0, -1.0)
    full = [np.flatnonzero(r) for r in x]
    rows = L.SparseRows([c.astype("<u2").tobytes() for c in full], [r[c].astype("<f2").tobytes() for r, c in zip(x, full)], 60)
    dense = x.astype(np.float64)
    assert rows.dot(np.arange(60.0)) == pytest.approx(dense @ np.arange(60.0))
    assert rows.pull(y) == pytest.approx(y @ dense)
    w, b = L.fit_svm(rows, y)
    v, c = L.fit_svm(dense, y)
    assert w == pytest.approx(v, abs=1e-4) and b == pytest.approx(c, abs=1e-4)


def test_three_related_languages_vote(spark):
    """A family of three needs three machines; unlisted codes are families of their own."""
    rng = random.Random(6)
    parts = {"aa": "ka lo mi".split(), "bb": "ka lo ti".split(), "cc": "ka zu ti".split(), "dd": "x q w".split()}
    word = lambda l: "".join(rng.choice(parts[l]) for _ in range(4))
    rows = [(i, " ".join(word(l) for _ in range(30)), l) for i, l in enumerate(l for l in parts for _ in range(60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(spark, docs, families={"aa": "f", "bb": "f", "cc": "f"})
    assert len(model.language_machines["f"]) == 3 and model.families == ["dd", "f"]
    got = {r["doc_id"]: r["lang_pred"] for r in L.identify(spark, docs, model).collect()}
    assert np.mean([got[i] == l for i, _, l in rows]) > 0.95


def test_votes_equal_brute_force():
    """Family first, then the languages of that family, each by one-versus-one votes."""
    families = {"aa": "f", "bb": "f", "cc": "f", "dd": "g", "ee": "g"}
    model = L.Discriminator(["ee", "aa", "zz", "cc", "bb", "dd"], families, buckets=L.BUCKETS)
    rng = np.random.default_rng(5)
    model.weights = rng.normal(size=model.weights.shape).astype(np.float32) * 30
    model.bias = rng.normal(size=model.bias.shape) * 0.1
    texts = [" ".join("".join(rng.choice(list("abcdefg"), 5)) for _ in range(12)) for _ in range(300)]
    m = L.features(texts).astype(np.float64) @ model.weights + model.bias

    def winner(names, machines, row):
        if len(names) == 1:
            return names[0], 1.0
        votes, worst = dict.fromkeys(names, 0.0), dict.fromkeys(names, np.inf)
        for a, b, k in machines:
            first, value = (a, b), row[k]
            won, lost = first if value >= 0 else first[::-1]
            votes[won] += 1 + np.tanh(abs(value)) * 1e-3
            votes[lost] -= np.tanh(abs(value)) * 1e-3
            worst[a], worst[b] = min(worst[a], value), min(worst[b], -value)
        best = max(names, key=lambda n: (votes[n], -names.index(n)))
        return best, 1 / (1 + np.exp(-4 * np.clip(worst[best], -20, 20)))

    lang, score = model.predict(texts)
    assert {families.get(x, x) for x in lang} == {"f", "g", "zz"}
    for i, row in enumerate(m):
        family, sure = winner(model.families, model.family_machines, row)
        want, inner = winner(model.members[family], model.language_machines[family], row)
        assert lang[i] == want and score[i] == pytest.approx(sure * inner, rel=1e-3)
    # every language is on the side of its family in the family machines, and in its own machines
    sides = {(k, l): side for k, l, side, _ in model.sides()}
    for a, b, k in model.family_machines:
        assert {l for (n, l), side in sides.items() if n == k and side > 0} == set(model.members[a])
        assert {l for (n, l), side in sides.items() if n == k and side < 0} == set(model.members[b])


def test_large_families_are_thinned_for_family_machines():
    model = L.Discriminator([f"l{i:02}" for i in range(12)] + ["x"], {f"l{i:02}": "f" for i in range(12)})
    shares = {share for k, l, _, share in model.sides() if (k == model.family_machines[0][2]) and l != "x"}
    assert shares == {L.FAMILY_LANGUAGES / 12}


def test_language_edges(spark, edge_docs, no_docs):
    from pyspark.sql import functions as F
    model = L.fit(spark, edge_docs.withColumn("lang", F.when(F.col("doc_id") > 4, "en").when(F.col("doc_id") > 1, "fr")))
    got = L.identify(spark, edge_docs, model, names=("found", "sure"))
    assert got.columns == edge_docs.columns + ["found", "sure"]
    rows = got.collect()
    assert len(rows) == edge_docs.count()
    assert {r["found"] for r in rows if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert all(r["found"] != "und" for r in rows if r["doc_id"] in (4, 5, 6, 7, 8))
    assert L.fit(spark, no_docs) is None
    assert L.identify(spark, no_docs, None).count() == 0
    assert {r["lang_pred"] for r in L.identify(spark, edge_docs.select("doc_id", "text"), None).collect()} == {"und"}


# -- embeddings ---------------------------------------------------------------

def brute_links(ids, vectors, threshold=0.95):
    ok = np.array([v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v)
                   for v in vectors])
    u = np.array([np.array(v, dtype=np.float64) if o else np.zeros(64) for v, o in zip(vectors, ok)])
    n = np.linalg.norm(u, axis=1)
    u = u / np.where(n > 0, n, 1)[:, None]
    link = (u @ u.T >= threshold) & ok[:, None] & ok[None, :]
    np.fill_diagonal(link, False)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in zip(*np.nonzero(link)):
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return link.sum(axis=1), [ids[find(i)] for i in range(len(ids))]


def near(rng, v, cosine):
    """A unit vector at this cosine to ``v``."""
    v = v / np.linalg.norm(v)
    r = rng.normal(size=len(v))
    r -= (r @ v) * v
    return cosine * v + np.sqrt(1 - cosine ** 2) * r / np.linalg.norm(r)


@pytest.fixture(scope="module")
def planted():
    """Background, pairs around the threshold, a dense group, copies and vectors without links; ids ascending."""
    rng = np.random.default_rng(11)
    back = rng.normal(size=(2500, 64))
    vectors = [*back]
    for i in range(400):
        vectors.append(near(rng, back[i], 0.951 + 0.04 * (i % 2)))
        vectors.append(near(rng, back[i + 400], 0.945))
    vectors += [near(rng, back[2000], 0.99) for _ in range(300)]
    vectors += [back[2100]] * 150 + [back[2100] * 3] * 3
    out = [v.astype(np.float32).tolist() for v in vectors]
    out += [None, [], [0.0] * 64, [None] * 64, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63, [1.0] * 63]
    return list(range(len(out))), out


@pytest.mark.parametrize("members, queries", [(E.MEMBERS_PER_BLOCK, E.QUERIES_PER_BLOCK), (40, 100)])
def test_links_recall_against_brute_force(spark, planted, members, queries):
    ids, vectors = planted
    df = spark.createDataFrame(list(zip(ids, vectors, ["x"] * len(ids))), "vec_id long, embedding array<float>, component string")
    got = {r["vec_id"]: r for r in E.embedding_links(spark, df, members_per_block=members, queries_per_block=queries).collect()}
    links, component = brute_links(ids, vectors)
    assert len(got) == len(ids)
    found = np.array([got[i]["n_links"] for i in ids])
    assert (found <= links).all()                                   # none below the threshold
    assert found.sum() >= 0.99 * links.sum()
    same = [got[i]["component_id"] == c for i, c in zip(ids, component)]
    assert np.mean(same) >= 0.99
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in ids)
    pairs = [i for i in range(2500, 3300) if links[i]]              # pairs at 0.951 to 0.991
    assert sum(found[i] for i in pairs) >= 0.98 * sum(links[i] for i in pairs)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in ids[-7:])


def test_links_are_counted_on_both_sides(spark):
    """With few probes many pairs are found from one side only; both vectors have the link all the same."""
    rng = np.random.default_rng(8)
    back = rng.normal(size=(3000, 32))
    vectors = [v.astype(np.float32).tolist() for v in [*back, *(near(rng, v, 0.952) for v in back[:600]), *back[:40]]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in E.embedding_links(spark, df, probes=2).collect()}
    of = {}
    for r in got.values():
        of.setdefault(r["component_id"], []).append(r["vec_id"])
    pairs = [c for c in of.values() if len(c) == 2]
    assert len(pairs) > 300
    assert all(got[i]["n_links"] == 1 for c in pairs for i in c)
    assert all(got[i]["n_links"] == 2 for c in of.values() if len(c) == 3 for i in c)   # a copy, and one near both
    assert all(got[c[0]]["n_links"] == 0 for c in of.values() if len(c) == 1)


def test_each_length_is_searched(spark):
    rng = np.random.default_rng(9)
    short, long = rng.normal(size=(60, 8)), rng.normal(size=(50, 24))
    vectors = [v.tolist() for v in [*short, *long, *(near(rng, v, 0.97) for v in short[:20]), *(near(rng, v, 0.97) for v in long[:20])]]
    vectors.append([1.0] * 5)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in E.embedding_links(spark, df).collect()}
    assert all(got[110 + i]["component_id"] == i == got[i]["component_id"] for i in range(20))
    assert all(got[130 + i]["component_id"] == 60 + i for i in range(20))
    assert all(got[i]["n_links"] >= 1 for i in range(110, 150))
    assert got[150]["kept"] and got[150]["n_links"] == 0


def test_lookup_distances_lose_nothing_in_a_list():
    rng = np.random.default_rng(3)
    x = E.unit(rng.normal(size=(1500, 48)))
    q = np.array([near(rng, v, 0.9505) for v in x[:500]])
    model = E.Quantiser(x, 4)
    home = model.home(x)
    for cell in range(4):
        own = x[home == cell]
        want = {(i, j) for i, j in zip(*np.nonzero(np.einsum("ik,jk->ij", q, own) >= 0.95))}
        got = {(i, j) for a, b in E.search(model, cell, own, q, 0.95) for i, j in zip(a.tolist(), b.tolist())}
        assert got == want


def test_embedding_query_and_edges(spark):
    t = pq.read_table(f"{SMALL}/embeddings.parquet").to_pydict()
    links, component = brute_links(t["vec_id"], t["embedding"])
    got = {r["vec_id"]: r for r in E.op7_embedding_pq(spark, SMALL).collect()}
    assert [got[i]["n_links"] for i in t["vec_id"]] == links.tolist()
    assert [got[i]["component_id"] for i in t["vec_id"]] == component
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert E.embedding_links(spark, none).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in E.embedding_links(spark, nulls).orderBy("vec_id").collect()] == [(1, 0, 1, True), (2, 0, 2, True)]


# -- mixing -------------------------------------------------------------------

def brute_rates(cells, steps):
    """The projected steps, one after the other."""
    p, r = np.array(cells) / 1000, np.ones(len(cells))
    for step in steps:
        r = np.maximum(0, r - p @ np.array(step))
    return r


def test_fit_reaches_targets(spark):
    rng = np.random.default_rng(2)
    cells = [[int(v) for v in np.round(1000 * rng.dirichlet([0.2, 0.2, 0.2]))] for _ in range(300)]
    tokens = [int(n) for n in rng.integers(1, 2000, 300)]
    df = spark.createDataFrame(list(zip(cells, tokens)), "cell array<int>, tokens long")
    p = np.array(cells) / 1000
    targets = [float(x) for x in (np.array(tokens) @ p) * [0.9, 0.4, 0.05]]
    steps, reached = M.fit_rates(df, targets)
    assert reached == pytest.approx(targets, rel=1e-3)
    from pyspark.sql import functions as F
    got = [r["r"] for r in df.select(M.rate_of(F.col("cell"), steps).alias("r")).collect()]
    assert got == pytest.approx(brute_rates(cells, steps).tolist(), abs=1e-9)
    assert brute_rates(cells, steps) * np.array(tokens) @ p == pytest.approx(reached)
    assert min(got) >= 0


def test_fit_of_unreachable_targets_is_least_squares(spark):
    """One shared posterior cannot meet two targets: the weighted residuals balance."""
    df = spark.createDataFrame([([500, 500], 100)], "cell array<int>, tokens long")
    steps, reached = M.fit_rates(df, [90.0, 10.0])
    assert reached == pytest.approx([50.0, 50.0], rel=0.02)


def brute_cell(text, prior, weights, cells=1000):
    """Words of a text and its posteriors in units of 1/cells."""
    import re
    import struct
    import xxhash
    buckets = len(weights[0])

    def bucket(*parts):
        h = 42
        for n, x in enumerate(parts):                   # a word, or a kind (int) and a word or a number (long)
            raw = x.encode() if isinstance(x, str) else struct.pack("<i" if n == 0 else "<q", x)
            h = xxhash.xxh64_intdigest(raw, seed=h)
        return (h - (1 << 64) if h >> 63 else h) % buckets

    words = re.split("[ \t\n\x0b\f\r]+", text or "")
    own = {bucket(w) for w in words}
    bag = own | {bucket(1, w[-1:]) for w in words} | {bucket(2, int(len(own) / len(words) * 10))}
    logs = np.array([p + sum(w[b] for b in bag) for p, w in zip(prior, weights)])
    odds = np.exp(logs - logs.max())
    return len([w for w in words if w]), odds / odds.sum() * cells


def test_posteriors_equal_brute_force(spark, small_docs, edge_rows):
    rng = np.random.default_rng(4)
    prior, weights = [0.2, -0.1, 0.0], (rng.normal(size=(3, 128)) * (rng.random((3, 128)) < 0.5) * 0.3).tolist()
    rows = small_docs[:60] + edge_rows
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(rows)], "n long, text string")
    got = {r["n"]: r for r in M.posteriors(df, prior, weights).collect()}
    for n, (_, t) in enumerate(rows):
        tokens, cell = brute_cell(t, prior, weights)
        assert got[n]["__tokens"] == tokens
        assert np.abs(np.array(got[n]["__cell"]) - cell).max() <= 0.5 + 1e-6


def test_mixing_query(spark):
    got = M.op2_soft_mixing(spark, MID).collect()
    t = pq.read_table(f"{MID}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    words = {i: len((x or "").split()) for i, x in zip(t["doc_id"], t["text"])}
    assert len(got) == len(words)
    assert all(r["n_tokens"] == words[r["doc_id"]] for r in got)
    assert all(abs(r["p_good"] + r["p_poor"] + r["p_toxic"] - 1) < 0.0021 and r["rate"] >= 0 for r in got)
    totals = {d: sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in got) for d in M.DOMAINS}
    whole = sum(totals.values())
    for d in M.DOMAINS:
        assert totals[d] / whole == pytest.approx(M.WEIGHTS[d], abs=0.01)
    labels = pq.read_table(f"{MID}/labels.parquet").to_pydict()
    truth = {i: "toxic" if x else "good" if q else "poor" for i, q, x in zip(labels["doc_id"], labels["quality"], labels["toxic"])}
    by = {r["doc_id"]: max(M.DOMAINS, key=lambda d: r[f"p_{d}"]) for r in got}
    assert np.mean([by[i] == d for i, d in truth.items()]) > 0.95
    rate = {r["doc_id"]: r["rate"] for r in got}
    assert np.mean([rate[i] for i, d in truth.items() if d == "good"]) > 0.95
    assert np.mean([rate[i] for i, d in truth.items() if d == "toxic"]) < 0.2


def test_mixing_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, "good"), (6, "poor"), (7, "poor"), (7, "poor"), (99, "good"), (None, "good")],
                                   "doc_id long, domain string")
    mixed, targets, reached = M.mix(spark, edge_docs, labels)
    assert mixed.count() == edge_docs.count()
    assert M.sample_by_rate(mixed).columns == edge_docs.columns
    mixed, targets, reached = M.mix(spark, edge_docs, labels.limit(0))
    assert {tuple(r["__cell"]) for r in mixed.collect()} == {(333, 333, 333)}
    mixed, _, _ = M.mix(spark, no_docs, labels)
    assert mixed.count() == 0


def test_sampling_follows_rates(spark):
    from pyspark.sql import functions as F
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit(1).alias("__tokens"), F.lit(1).alias("__cell"),
                                   F.when(F.col("id") < 10000, 0.25).otherwise(1.5).alias("__rate"))
    ids = [r["doc_id"] for r in M.sample_by_rate(df).collect()]
    assert len(ids) == len(set(ids))
    assert sum(i >= 10000 for i in ids) == 10000
    assert abs(sum(i < 10000 for i in ids) - 2500) < 200
