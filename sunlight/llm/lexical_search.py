"""Ranked lexical search with pipelined term partitioning.

Terms are dealt to owners: owner 0 has the rarest, the last one the commonest,
each about the same number of postings. For every block of documents, a bundle
of items carries sparse accumulators (document, score) from owner to owner: a
stage is a cogroup of the bundles with the postings of one owner, which adds that
owner's integer contributions and sends the bundle on. A last cogroup with the
documents' ids selects the best of each block, and a window the best of all.

Nothing is approximate. After a stage a bundle knows the k-th best score in
its block so far, and how much the owners to come can add at most; a document
that cannot reach that score any more is dropped, and an item whose unseen
documents cannot reach it takes no new ones. As the rarest terms, which weigh
most, come first, later stages mostly update what is there.

Index: one pass over the texts counts the terms that items ask for and all
terms of a document; blocks of at most ``BLOCK_DOCS`` documents and about ``BLOCK_POSTINGS``
postings are formed where they are read, without a shuffle. Statistics over all
documents give weights, owners and the integer impact of each posting; the index is written by
owner, so that a stage reads its owner's folder alone. A cogroup's group is one block and at most
``BUNDLE_ITEMS`` items, whatever the documents or the terms, so no group grows with the data.

Items are taken in parts of about ``PART_ITEMS`` items and ``PART_TERMS`` different
terms, whose terms are broadcast; more items make more parts, each with an
index of its own.

Defined cases: a null text has no terms; an item without terms, or without a
document that scores above 0, has no rows. Equal rows of items are one item; rows of
one item_id with different texts are ranked each. Documents with the same id are ranked each,
and a null id comes after all others. Without documents or items the result is empty. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sunlight.session import scratch_path

from .common import doc_key, from_key, stash, table

TOP = 20
OWNERS = 4
BLOCK_DOCS = 4096                       # at most 65536: places in a block are 16 bits
BLOCK_POSTINGS = 1 << 20
BUNDLE_ITEMS = 256
PART_ITEMS, PART_TERMS = 4096, 200_000

# Fixed values of the score: weights in thousandths, impacts in millionths, length share 25 of 100.
IMPACT, SATURATION, LENGTH_SHARE = 1_000_000_000, 12, 25

# Digits, letters in lower case and every byte of other characters stand; the rest parts terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                    for c in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order."""
    return raw.translate(_TERM_BYTES).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def norm(n, documents: int, length: int):
    """Length norm m of documents of ``n`` terms."""
    return 100 - LENGTH_SHARE + LENGTH_SHARE * n * documents // length


def impact(tf, m):
    return IMPACT * tf // (1000 * tf + SATURATION * m)


# -- items ------------------------------------------------------------------

def item_terms(spark: SparkSession, items: DataFrame, item_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Written (item, item_id) and (item, term, repeats); ``item`` numbers the different rows."""
    numbered = stash(spark, items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
                     .distinct().withColumn("item", F.monotonically_increasing_id()), "search-items")

    def run(batches):
        for b in batches:
            rows = [(i, t.decode("utf-8", "replace"), c)
                    for i, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for t, c in Counter(terms_of(raw)).items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.int64()))],
                names=["item", "term", "repeats"])

    terms = numbered.where("text IS NOT NULL").select("item", F.encode("text", "UTF-8").alias("raw")) \
        .mapInArrow(run, "item long, term string, repeats long")
    return numbered.select("item", "item_id"), stash(spark, terms, "search-item-terms")


# -- index ------------------------------------------------------------------

RAW_SCHEMA = ("ids binary, n binary, documents long, length long, terms array<int>, df array<long>, "
              "most array<long>, least_n array<long>, docs binary, tfs binary")


def _block(ids: list, lengths: list, terms: list, docs: list, tfs: list, other: tuple[int, int]) -> pa.RecordBatch:
    """One block as a row: postings by term, in each by place; ``other`` counts documents and
    terms that have no posting here."""
    term, doc, tf = np.array(terms, np.int32), np.array(docs, np.uint16), np.array(tfs, np.int64)
    n = np.array(lengths, np.int64)
    order = np.argsort(term, kind="stable")
    term, doc, tf = term[order], doc[order], tf[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[starts, len(term)])
    most = np.maximum.reduceat(tf, starts) if len(starts) else tf
    least = np.minimum.reduceat(n[doc], starts) if len(starts) else tf
    one = lambda values, kind: pa.array([values], kind)
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [one(np.array(ids, "<i8").tobytes(), pa.binary()), one(n.astype("<i8").tobytes(), pa.binary()),
         one(len(ids) + other[0], pa.int64()), one(int(n.sum()) + other[1], pa.int64()),
         one(term[starts], pa.list_(pa.int32())), one(counts, longs), one(most, longs), one(least, longs),
         one(doc.astype("<u2").tobytes(), pa.binary()), one(tf.astype("<i4").tobytes(), pa.binary())],
        names=["ids", "n", "documents", "length", "terms", "df", "most", "least_n", "docs", "tfs"])


def raw_index(spark: SparkSession, docs: DataFrame, wanted: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Written blocks of documents with the frequencies of the wanted terms, as read."""
    sent = spark.sparkContext.broadcast(wanted)

    def run(batches):
        number = sent.value.get
        ids, lengths, terms, places, tfs, other = [], [], [], [], [], [0, 0]
        for b in batches:
            raws = pc.fill_null(b.column(1).cast(pa.binary()), b"")
            for doc, raw in zip(b.column(0).to_pylist(), (r.as_py() for r in raws)):
                words = terms_of(raw)
                if not words:
                    continue
                own = [(t, c) for w, c in Counter(words).items() if (t := number(w)) is not None]
                if not own:
                    other[0] += 1
                    other[1] += len(words)
                    continue
                for t, c in own:
                    terms.append(t)
                    tfs.append(c)
                places.extend([len(ids)] * len(own))
                ids.append(doc)
                lengths.append(len(words))
                if len(ids) >= BLOCK_DOCS or len(terms) >= BLOCK_POSTINGS:
                    yield _block(ids, lengths, terms, places, tfs, other)
                    ids, lengths, terms, places, tfs, other = [], [], [], [], [], [0, 0]
        if ids or other[0]:
            yield _block(ids, lengths, terms, places, tfs, other)

    blocks = docs.select(doc_key(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text")) \
        .mapInArrow(run, RAW_SCHEMA).withColumn("block", F.monotonically_increasing_id())
    return stash(spark, blocks, "search-blocks")


def deal_terms(df: np.ndarray, owners: int) -> np.ndarray:
    """Owner of each term: by rising document frequency, an even share of the postings each."""
    order = np.argsort(df, kind="stable")
    upto = np.cumsum(df[order])
    out = np.empty(len(df), np.int32)
    out[order] = np.minimum(owners - 1, (upto - 1) * owners // max(1, int(upto[-1]) if len(df) else 1))
    return np.maximum(out, 0)


def owner_index(spark: SparkSession, blocks: DataFrame, owner_of: np.ndarray, owners: int, documents: int,
                length: int) -> list[DataFrame]:
    """Postings with their impacts, per owner: (block, terms, counts, docs, impacts)."""
    sent = spark.sparkContext.broadcast(owner_of)

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                term, counts = np.array(row["terms"], np.int32), np.array(row["df"], np.int64)
                doc = np.frombuffer(row["docs"], "<u2")
                m = norm(np.frombuffer(row["n"], "<i8"), documents, length)
                worth = impact(np.frombuffer(row["tfs"], "<i4").astype(np.int64), m[doc]).astype("<i4")
                owner = sent.value[term]
                of_posting = np.repeat(owner, counts)
                for k in np.unique(owner).tolist():
                    mine, here = owner == k, of_posting == k
                    yield pa.RecordBatch.from_pylist([{
                        "owner": k, "block": row["block"], "terms": term[mine].tobytes(),
                        "counts": counts[mine].astype("<i4").tobytes(), "docs": doc[here].tobytes(),
                        "impacts": worth[here].tobytes()}], schema=made)

    made = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary()),
                      ("docs", pa.binary()), ("impacts", pa.binary())])
    fields = "block long, terms binary, counts binary, docs binary, impacts binary"
    path = scratch_path(spark, "llm-search-postings")
    (blocks.select("block", "terms", "df", "docs", "tfs", "n").mapInArrow(run, f"owner int, {fields}")
     .write.partitionBy("owner").parquet(path))
    index = spark.read.schema(f"{fields}, owner int").parquet(path)
    return [index.where(F.col("owner") == k).drop("owner") for k in range(owners)]


# -- stages -----------------------------------------------------------------

BUNDLE_SCHEMA = "block long, bundle int, counts binary, docs binary, scores binary, open binary"


class Plan:
    """What the bundles ask of each owner.

    ``asked[bundle][owner]``: (item in the bundle, term, weight x repeats), by item;
    ``rest[bundle][owner]``: what later owners can add to each item at most.
    """

    def __init__(self, pairs: list[tuple[int, int, int]], items: int, owner_of: np.ndarray, weights: np.ndarray,
                 most: np.ndarray, owners: int):
        self.items, self.owners = items, owners
        bundles = max(1, math.ceil(items / BUNDLE_ITEMS))
        pairs = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        item, term, repeats = pairs.T
        worth = weights[term] * repeats
        self.sizes = [min(BUNDLE_ITEMS, items - k * BUNDLE_ITEMS) for k in range(bundles)]
        self.asked, self.rest = [], []
        for k in range(bundles):
            in_bundle = item // BUNDLE_ITEMS == k
            per_owner, bound = [], np.zeros((owners, self.sizes[k]), np.int64)
            for o in range(owners):
                here = in_bundle & (owner_of[term] == o)
                local = item[here] - k * BUNDLE_ITEMS
                per_owner.append((local, term[here].astype(np.int32), worth[here]))
                np.add.at(bound[o], local, worth[here] * most[term[here]])
            self.asked.append(per_owner)
            self.rest.append(bound.sum(axis=0) - np.cumsum(bound, axis=0))


def _unpack(bundle: pd.DataFrame, size: int):
    """(documents, scores) of each item, and which items still take new documents."""
    row = bundle.iloc[0]
    if row["counts"] is None:
        return [np.zeros(0, np.uint16)] * size, [np.zeros(0, np.int64)] * size, np.ones(size, bool)
    ends = np.cumsum(np.frombuffer(row["counts"], "<i4"))[:-1]
    return (np.split(np.frombuffer(row["docs"], "<u2"), ends), np.split(np.frombuffer(row["scores"], "<i8"), ends),
            np.frombuffer(row["open"], np.uint8).astype(bool))


def add_owner(key: tuple, bundle: pd.DataFrame, postings: pd.DataFrame, plan: Plan, owner: int, k: int) -> pd.DataFrame:
    """The bundle after this owner's contributions."""
    if not len(bundle):
        return bundle.assign(block=pd.Series(dtype="int64"))
    block, number = int(key[0]), int(key[1])
    docs, scores, opened = _unpack(bundle, plan.sizes[number])
    docs, scores, opened = list(docs), list(scores), opened.copy()
    local, term, worth = plan.asked[number][owner]
    if len(postings):
        own = postings.iloc[0]
        own_terms = np.frombuffer(own["terms"], "<i4")
        at = np.minimum(np.searchsorted(own_terms, term), len(own_terms) - 1)
        found = np.flatnonzero(own_terms[at] == term)
        ends = np.cumsum(np.frombuffer(own["counts"], "<i4").astype(np.int64))
        starts = np.r_[0, ends[:-1]]
        places, impacts = np.frombuffer(own["docs"], "<u2"), np.frombuffer(own["impacts"], "<i4")
        scratch = np.zeros(1 << 16, np.int64)
        cuts = np.searchsorted(local[found], np.arange(plan.sizes[number] + 1))
        for i in range(plan.sizes[number]):
            if cuts[i] == cuts[i + 1]:
                continue
            before = docs[i]
            scratch[before] = scores[i]
            touched = [before]
            for f in found[cuts[i]:cuts[i + 1]]:
                posted = slice(starts[at[f]], ends[at[f]])
                here = places[posted]
                scratch[here] += worth[f] * impacts[posted]
                touched.append(here)
            if opened[i]:
                before = np.unique(np.concatenate(touched))
            docs[i], scores[i] = before, scratch[before]
            for here in touched:
                scratch[here] = 0
    for i, rest in enumerate(plan.rest[number][owner].tolist()):
        if len(scores[i]) > k:
            least = np.partition(scores[i], -k)[-k]
            kept = scores[i] + rest >= least
            docs[i], scores[i] = docs[i][kept], scores[i][kept]
            opened[i] &= rest >= least
    return pd.DataFrame({
        "block": [block], "bundle": [number], "counts": [np.array([len(d) for d in docs], "<i4").tobytes()],
        "docs": [b"".join(d.astype("<u2").tobytes() for d in docs)],
        "scores": [b"".join(s.astype("<i8").tobytes() for s in scores)], "open": [opened.astype(np.uint8).tobytes()]})


def select_best(key: tuple, bundle: pd.DataFrame, ids: pd.DataFrame, plan: Plan, k: int) -> pd.DataFrame:
    """The ``k`` best documents of each item of a bundle: item, doc, score, place."""
    none = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("item", "doc", "score", "place")})
    if not len(bundle) or not len(ids):
        return none
    number = int(key[1])
    docs, scores, _ = _unpack(bundle, plan.sizes[number])
    doc_of, parts = np.frombuffer(ids["ids"].iloc[0], "<i8"), []
    for i in range(plan.sizes[number]):
        good = scores[i] > 0
        place, score = docs[i][good].astype(np.int64), scores[i][good]
        best = np.lexsort((place, doc_of[place], -score))[:k]
        parts.append(pd.DataFrame({"item": number * BUNDLE_ITEMS + i, "doc": doc_of[place[best]],
                                   "score": score[best], "place": place[best]}))
    return pd.concat(parts) if parts else none


def rank_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                   k: int = TOP, owners: int = OWNERS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of each item."""
    named, terms = item_terms(spark, items, item_col, item_text_col)
    parts = max(1, math.ceil(named.count() / PART_ITEMS), math.ceil(terms.select("term").distinct().count() / PART_TERMS))
    found = None
    for part in range(parts):
        own = terms.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        ranked = _rank_part(spark, docs, own, id_col, text_col, k, owners)
        if ranked is not None:
            found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        return named.where("false").select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                                           F.lit(0).cast("long").alias("score"))
    return found.join(named, "item").select("item_id", F.col("rank").cast("int").alias("rank"),
                                            from_key("doc").alias("doc_id"), "score")


def _rank_part(spark: SparkSession, docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, k: int,
               owners: int) -> DataFrame | None:
    """item, doc, score, rank for the items of one part."""
    asked = [(r["item"], r["term"], r["repeats"]) for r in terms.collect()]     # bounded: one part of the items
    if not asked:
        return None
    item_of = {item: at for at, item in enumerate(sorted({a[0] for a in asked}))}
    names = sorted({a[1] for a in asked})
    number = {t: at for at, t in enumerate(names)}
    blocks = raw_index(spark, docs, {t.encode("utf-8"): at for t, at in number.items()}, id_col, text_col)
    size = blocks.agg(F.sum("documents"), F.sum("length")).first()
    documents, length = size[0] or 0, size[1] or 0
    if not documents:
        return None
    # One row per wanted term.
    known = blocks.select(F.explode(F.arrays_zip("terms", "df", "most", "least_n")).alias("t")).groupBy("t.terms").agg(
        F.sum("t.df").alias("df"), F.max("t.most").alias("most"), F.min("t.least_n").alias("n")).collect()
    df, most = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    for r in known:
        df[r["terms"]] = r["df"]
        most[r["terms"]] = impact(r["most"], norm(r["n"], documents, length))
    owner_of = deal_terms(df, owners)
    plan = Plan([(item_of[i], number[t], c) for i, t, c in asked], len(item_of), owner_of,
                np.array([weight(documents, int(n)) for n in df], np.int64), most, owners)
    index = owner_index(spark, blocks, owner_of, owners, documents, length)
    sent = spark.sparkContext.broadcast(vars(plan))
    every_bundle = F.explode(F.sequence(F.lit(0), F.lit(len(plan.sizes) - 1)))
    empty = F.lit(None).cast("binary")

    def stage(owner: int):
        def run(key, bundle, postings):
            return add_owner(key, bundle, postings, _plan(sent.value), owner, k)
        return run

    def last(key, bundle, ids):
        return select_best(key, bundle, ids, _plan(sent.value), k)

    bundles = blocks.select("block", every_bundle.alias("bundle"), *[empty.alias(c) for c in ("counts", "docs", "scores", "open")])
    for owner, postings in enumerate(index):
        bundles = bundles.groupBy("block", "bundle").cogroup(
            postings.withColumn("bundle", every_bundle).groupBy("block", "bundle")).applyInPandas(stage(owner), BUNDLE_SCHEMA)
    best = bundles.groupBy("block", "bundle").cogroup(
        blocks.select("block", "ids", every_bundle.alias("bundle")).groupBy("block", "bundle")) \
        .applyInPandas(last, "item long, doc long, score long, place long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc", "place")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    rows = spark.createDataFrame([(at, item) for item, at in item_of.items()], "item long, item_row long")
    return ranked.join(F.broadcast(rows), "item").select(F.col("item_row").alias("item"), "doc", "score", "rank")


def _plan(state: dict) -> Plan:
    made = Plan.__new__(Plan)
    vars(made).update(state)
    return made


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH cut AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
sized AS (SELECT doc_id, terms, len(terms) AS n FROM cut WHERE len(terms) > 0),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sized),
asked AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term),
posted AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized)
    WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, n, term),
weighed AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM posted, total GROUP BY term, nn),
scored AS (SELECT a.item_id, p.doc_id, sum(a.q * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * p.n * nn) // ll))))::BIGINT AS score
    FROM asked a JOIN posted p ON a.term = p.term JOIN weighed w ON w.term = p.term, total GROUP BY a.item_id, p.doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
