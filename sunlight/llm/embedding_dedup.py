"""Embedding near-duplicates through product quantisation.

Different vectors are dealt to coarse inverted lists (nearest centroid), and
the residual to the centroid is encoded as one code per subspace where a list's block is
searched (the exact rerank needs the vectors there anyway). Every vector
is a query against the lists it probes: a table of inner products with all
codewords gives asymmetric distances by lookup, and a member goes on to the
exact double-precision cosine unless its looked-up distance exceeds the
threshold's distance by more than the member's own quantisation error. That
test never loses a link inside a probed list; only an unprobed list can.
``PROBES`` of the nearest lists keep the measured recall above 0.99 for pairs
right at the threshold (see the tests), and all lists are probed while there
are no more than that.

Centroids and codebooks are fitted on the driver from a sample of at most
about ``FITTED`` vectors and broadcast (at most 4096 centroids and 256
codewords per subspace; ``FITTED_VALUES`` bounds the sample of long vectors). Every
vector is indexed. A list with many members or
many queries is cut into blocks of bounded size, each pair of blocks a group
of its own; a group returns link counts and a spanning forest of its links,
never its pairs. Equal vectors are collapsed to one with a weight.

A pair may be found from one side only: its query probes the member's list, but
the member does not probe the query's. Members carry their probes and queries
their list, so such a link is counted for both, and exactly once for each.

Vectors of each length are searched by themselves, with a quantiser of their own.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and stand alone. Rows with the same vec_id count as vectors of their
own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import doc_key, from_key, restored, stash, table
from .components import connected_components

THRESHOLD = 0.95
PROBES = 24
FITTED = 1 << 15
FITTED_VALUES = 1 << 23
MOST_LISTS = 4096
SUBSPACES = 8
CODEWORDS = 256
MEMBERS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 1 << 14
AT_ONCE = 512
PAIRS_AT_ONCE = 1 << 16


# -- the quantiser ---------------------------------------------------------

def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    return np.concatenate([(x[i:i + 4096] @ centres.T - half).argmax(axis=1)
                           for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def _kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, centres)
        n = np.bincount(at, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class Quantiser:
    """Coarse centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES):
        dim = sample.shape[1]
        self.lists = min(lists, len(sample))
        self.centres = _kmeans(sample, self.lists)
        self.parts = min(subspaces, dim)
        self.width = math.ceil(dim / self.parts)
        split = self._split(sample - self.centres[_nearest(sample, self.centres)])
        words = min(CODEWORDS, len(sample))
        self.books = np.stack([_kmeans(split[:, p], words, seed=p) for p in range(self.parts)])

    def _split(self, x: np.ndarray) -> np.ndarray:
        """(rows, subspaces, width), padded with zeros."""
        pad = self.parts * self.width - x.shape[1]
        return np.pad(x, ((0, 0), (0, pad))).reshape(len(x), self.parts, self.width)

    def home(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.centres)

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        half = (self.centres ** 2).sum(axis=1) / 2
        score = x @ self.centres.T - half
        if n >= self.lists:
            return np.tile(np.arange(self.lists), (len(x), 1))
        return np.argpartition(-score, n - 1, axis=1)[:, :n]

    def codes(self, residual: np.ndarray) -> np.ndarray:
        split = self._split(residual)
        return np.column_stack([_nearest(split[:, p], self.books[p]) for p in range(self.parts)])

    def decoded(self, codes: np.ndarray, dim: int) -> np.ndarray:
        return np.concatenate([self.books[p][codes[:, p]] for p in range(self.parts)], axis=1)[:, :dim]

    def tables(self, x: np.ndarray) -> np.ndarray:
        """(subspaces, rows, codewords) inner products of the queries' parts with the codewords."""
        return np.einsum("npw,pkw->pnk", self._split(x), self.books)


def list_count(rows: int) -> int:
    return max(1, min(MOST_LISTS, int(2 * math.sqrt(rows))))


# -- search ----------------------------------------------------------------

def _groups(a: np.ndarray, b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> pd.DataFrame:
    """Spanning forest of the links (a[i], b[i]): every linked node with the least id it reaches here."""
    nodes, at = np.unique(np.concatenate([ids_a[a], ids_b[b]]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    low = np.arange(len(nodes))
    while True:
        new = low.copy()
        np.minimum.at(new, x, low[y])
        np.minimum.at(new, y, low[x])
        new = new[new]
        if (new == low).all():
            return pd.DataFrame({"a": nodes, "b": nodes[low]})
        low = new


def search(quantiser: Quantiser, cell: int, members: np.ndarray, queries: np.ndarray, threshold: float):
    """(query row, member row) arrays of the links of a list, for slices of the queries."""
    residual = members - quantiser.centres[cell]
    codes = quantiser.codes(residual)
    guess = quantiser.centres[cell] + quantiser.decoded(codes, members.shape[1])
    error = np.linalg.norm(members - guess, axis=1)
    reach = math.sqrt(2 - 2 * threshold) + error
    # |q - guess|^2 <= reach^2, solved for the inner product of q and guess
    least = (1 + (guess ** 2).sum(axis=1) - reach ** 2) / 2 - 1e-9
    for start in range(0, len(queries), AT_ONCE):
        q = queries[start:start + AT_ONCE]
        tables = quantiser.tables(q)
        score = np.repeat((q @ quantiser.centres[cell])[:, None], len(members), axis=1)
        for p in range(quantiser.parts):
            score += tables[p][:, codes[:, p]]
        i, j = np.nonzero(score >= least)
        near = np.concatenate([
            np.einsum("ij,ij->i", q[i[s:s + PAIRS_AT_ONCE]], members[j[s:s + PAIRS_AT_ONCE]]) >= threshold
            for s in range(0, len(i), PAIRS_AT_ONCE)]) if len(i) else np.zeros(0, bool)
        yield i[near] + start, j[near]


def _matrix(blobs: pd.Series, dtype: str, dim: int) -> np.ndarray:
    return unit(np.frombuffer(b"".join(blobs), dtype=dtype).reshape(-1, dim))


def embedding_links(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, probes: int = PROBES, fitted: int = FITTED,
                    members_per_block: int = MEMBERS_PER_BLOCK,
                    queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    double = isinstance(vectors.schema[vector_col].dataType.elementType, T.DoubleType)
    kind = "<f8" if double else "<f4"

    def pack(batches):
        for b in batches:
            column = b.column(1)
            lists = column.flatten()
            flat = lists.to_numpy(zero_copy_only=False).astype(kind)      # null components become NaN
            n = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
            n[column.is_null().to_numpy(zero_copy_only=False)] = 0
            upto, out = np.r_[0, np.cumsum(n)], []
            for i in range(len(n)):
                v = flat[upto[i]:upto[i + 1]]
                out.append((v + v.dtype.type(0)).tobytes() if np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["id", "vec"])

    packed = stash(spark, vectors.select(
        doc_key(id_col).alias("id"),
        F.col(vector_col).cast("array<double>" if double else "array<float>").alias("vec"))
        .mapInArrow(pack, "id long, vec binary"), "vectors")
    distinct = stash(spark, packed.where("vec IS NOT NULL").groupBy("vec").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .withColumn("v", F.monotonically_increasing_id()), "vectors-distinct")
    # One row per length; a vector alone in its length has no links.
    sizes = distinct.groupBy(F.octet_length("vec").alias("bytes")).agg(F.count(F.lit(1)).alias("n")).collect()
    found = spark.createDataFrame([], "a long, b long, n long")
    for r in sorted(sizes):
        if r["n"] > 1:
            found = found.unionAll(_links_of_length(
                spark, distinct.where(F.octet_length("vec") == r["bytes"]), r["bytes"] // np.dtype(kind).itemsize, r["n"],
                kind, threshold, probes, fitted, members_per_block, queries_per_block))
    linked = found.where("n > 0").groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("links"))
    roots = connected_components(spark, found.where("n < 0").select("a", "b"))
    rooted = distinct.join(roots.withColumnRenamed("node", "v"), "v", "left") \
        .withColumn("root", F.coalesce("root", "v")).join(linked, "v", "left")
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select(
        "vec", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return packed.join(named, "vec", "left").select(
        from_key("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec").isNull(), from_key("id")).otherwise(from_key("component")).alias("component_id"),
        (F.coalesce("component", "id") == F.col("id")).alias("kept"))


def _links_of_length(spark: SparkSession, distinct: DataFrame, dim: int, count: int, kind: str, threshold: float,
                     probes: int, fitted: int, members_per_block: int, queries_per_block: int) -> DataFrame:
    """Written rows of two kinds for the vectors of one length: (a, -1, links) counts, (a, b, -1) forest."""
    fitted = max(1, min(fitted, FITTED_VALUES // dim))
    drawn = F.pmod(F.xxhash64("vec"), F.lit(1 << 20)) < F.lit(max(1, math.ceil((1 << 20) * min(1.0, fitted / count))))
    sample = distinct.where(drawn).select("vec").collect() or distinct.select("vec").limit(1).collect()
    model = Quantiser(unit(np.frombuffer(b"".join(r["vec"] for r in sample), kind).reshape(-1, dim)), list_count(count))
    del sample
    one_sided = probes < model.lists
    quantiser = spark.sparkContext.broadcast(vars(model))

    def deal(batches):
        fitted_to = restored(Quantiser, quantiser.value)
        for b in batches:
            x = _matrix(b["vec"], kind, dim) if len(b) else np.zeros((0, dim))
            yield pd.DataFrame({"v": b["v"], "copies": b["copies"], "vec": b["vec"],
                                "home": fitted_to.home(x).astype(np.int32),
                                "probes": list(fitted_to.probes(x, probes).astype(np.int32)) if len(x) else []})

    dealt = stash(spark, distinct.select("v", "copies", "vec").mapInPandas(
        deal, "v long, copies long, vec binary, home int, probes array<int>"), "vectors-dealt")
    members = dealt.select(F.col("home").alias("cell"), F.col("v").alias("mv"), F.col("vec").alias("mvec"),
                           F.col("copies").alias("weight"), F.col("probes").alias("asks"))
    queries = dealt.select(F.explode("probes").alias("cell"), F.col("v").alias("qv"), F.col("vec").alias("qvec"),
                           F.col("home").alias("qhome"), F.col("copies").alias("qcopies"))
    # One row per list, at most MOST_LISTS.
    blocks = members.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).join(
        queries.groupBy("cell").agg(F.count(F.lit(1)).alias("q")), "cell").select(
        "cell", F.ceil(F.col("m") / members_per_block).cast("int").alias("mbs"),
        F.ceil(F.col("q") / queries_per_block).cast("int").alias("qbs"))
    own_block = lambda v, n: F.pmod(F.xxhash64(v), F.col(n)).cast("int")
    each_block = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    m_side = members.join(F.broadcast(blocks), "cell").select(
        F.col("cell").alias("c"), own_block("mv", "mbs").alias("mb"), each_block("qbs").alias("qb"),
        "mv", "mvec", "weight", "asks")
    q_side = queries.join(F.broadcast(blocks), "cell").select(
        F.col("cell").alias("c"), own_block("qv", "qbs").alias("qb"), each_block("mbs").alias("mb"), "qv", "qvec",
        "qhome", "qcopies")

    def find(key: tuple, own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(own) and len(asked):
            x, q = _matrix(own["mvec"], kind, dim), _matrix(asked["qvec"], kind, dim)
            vx, vq, weight = own["mv"].to_numpy(), asked["qv"].to_numpy(), own["weight"].to_numpy()
            asks, home, copies = np.stack(own["asks"]), asked["qhome"].to_numpy(), asked["qcopies"].to_numpy()
            n, back = np.zeros(len(vq), np.int64), np.zeros(len(vx), np.int64)
            for i, j in search(restored(Quantiser, quantiser.value), int(key[0]), x, q, threshold):
                other = vq[i] != vx[j]
                i, j = i[other], j[other]
                np.add.at(n, i, weight[j])
                for s in range(0, len(i) if one_sided else 0, PAIRS_AT_ONCE):
                    qi, mj = i[s:s + PAIRS_AT_ONCE], j[s:s + PAIRS_AT_ONCE]
                    missed = (asks[mj] != home[qi][:, None]).all(axis=1)      # the member never asks the query's list
                    np.add.at(back, mj[missed], copies[qi[missed]])
                if len(i):
                    parts.append(_groups(i, j, vq, vx).assign(n=-1))
            for v, links in ((vq, n), (vx, back)):
                parts.append(pd.DataFrame({"a": v[links > 0], "b": -1, "n": links[links > 0]}))
        return pd.concat(parts) if parts else pd.DataFrame({"a": [], "b": [], "n": []}).astype("int64")

    return stash(spark, m_side.groupBy("c", "mb", "qb").cogroup(q_side.groupBy("c", "mb", "qb"))
                 .applyInPandas(find, "a long, b long, n long"), "vector-links")


def op7_embedding_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark, table(spark, sf_dir, "embeddings"))
