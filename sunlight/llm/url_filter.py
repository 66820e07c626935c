"""URL filters: a blocked Bloom filter in front of an exact hash join.

What is listed are canonical keys of two kinds: rules (a host with all its
subdomains and the start of a path, to allow or to block) and single URLs to
block. A URL offers the keys under which it could be listed: each of its host's
suffixes at a dot with each start of its path whose length some rule has, and
its own canonical form. A blocked Bloom filter of the listed keys (64 bytes a
block, one bit in each of its eight words) passes nearly only listed keys; the
possible hits alone reach the exact hash join with the list, which removes
the false positives. URLs without a possible hit pass straight through.

The longest fitting rule decides (of equally long ones that with the longer
host); without a rule a URL is blocked if it is listed and allowed otherwise.

Size: keys are dealt to blocks, and blocks to shards, by their hash; each
shard is built by one task from its own keys. Up to ``MOST_BROADCAST`` bytes
the filter is broadcast and a URL is judged where it is read. Beyond, the
distinct hashes of all offered keys go to the shards and those found come back:
no task or driver then holds more than a shard. A hot host costs no more
than another: keys are made distinct before they are dealt, and the exact
join is a broadcast of the list (up to ``BROADCAST_ROWS`` rows) or a hash join
whose hot keys AQE splits.

Defined cases: a null URL, and one without ``://``, has an empty host and path,
no canonical form, no rule, and is allowed. A listed URL that is null or has
no host is ignored. A key listed twice counts once, to block before to allow.
Repeated rows are judged each. An empty table gives an empty result; with an
empty list every URL is allowed. Other columns pass through unchanged.
"""

from __future__ import annotations

import math
from typing import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .common import stash, table

WORDS_PER_BLOCK = 8                       # of 64 bits: one cache line
BITS_PER_KEY = 16
BLOCKS_PER_SHARD = 1 << 15                # 2 MB, about a million keys
MOST_BROADCAST = 64 << 20
BROADCAST_ROWS = 100_000
SLICE_ROWS = 4096

# Fixed values: (host, path, verdict) of the production rules.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Words between dots and hyphens of a host whose pages are on the production list.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
# Query parameters that do not tell one page from another.
TRACKING = ("utm_", "ref=", "fbclid=", "gclid=")


# -- canonical form ---------------------------------------------------------

def _lower(text: str) -> str:
    return text if text.islower() else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def split_url(url: str | None) -> tuple[str, str, str]:
    """(host, path, query) as they stand, the host in lower case (A-Z only)."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", "", ""
    rest = url[at + 3:]
    rest = rest.partition("#")[0]
    rest, _, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    return _lower(host), slash + path, query


def canonical(url: str | None) -> str | None:
    """Host without user, port and ``www.``, path without a last slash, other parameters than
    tracking ones in order; no scheme or fragment. None without a host."""
    host, path, query = split_url(url)
    host = host.rpartition("@")[2].partition(":")[0].rstrip(".").removeprefix("www.")
    if not host:
        return None
    kept = sorted(p for p in query.split("&") if p and not p.startswith(TRACKING))
    return host + "/" + path.strip("/") + ("?" + "&".join(kept) if kept else "")


def rule_key(host: str, path: str) -> str:
    return f"r {host} {path}"


def url_key(url: str | None) -> str | None:
    form = canonical(url)
    return None if form is None else f"u {form}"


def offered_keys(url: str | None, host: str, path: str, lengths: Iterable[int], depth: int) -> list[str]:
    """Keys under which a URL could be listed: rules have hosts of at most ``depth`` labels
    and paths of these ``lengths``."""
    if not host:
        return []
    labels = host.rsplit(".", depth)
    suffixes = [".".join(labels[i:]) for i in range(len(labels) > depth, len(labels))]
    starts = [path[:n] for n in lengths if n <= len(path)]
    keys = [rule_key(h, s) for h in suffixes for s in starts]
    own = url_key(url)
    return keys if own is None else [*keys, own]


# -- the filter -------------------------------------------------------------

def key_hash(key: str) -> int:
    return xxhash.xxh3_64_intdigest(key.encode("utf-8", "surrogatepass"))


def block_count(keys: int) -> int:
    return max(1, math.ceil(keys * BITS_PER_KEY / (64 * WORDS_PER_BLOCK)))


def blocks_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """Block of each hash: its upper half, scaled."""
    return ((h >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def masks_of(h: np.ndarray) -> np.ndarray:
    """(hashes, words): one bit per word, from the lower half times the powers of an odd number."""
    low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None]
    with np.errstate(over="ignore"):
        odd = np.cumprod(np.full(WORDS_PER_BLOCK, 0x9E3779B1, np.uint32), dtype=np.uint32)
        return np.uint64(1) << ((low * odd) >> np.uint32(26)).astype(np.uint64)


def fill(h: np.ndarray, at: np.ndarray, blocks: int) -> np.ndarray:
    """Words of ``blocks`` blocks holding these hashes."""
    words = np.zeros((blocks, WORDS_PER_BLOCK), np.uint64)
    np.bitwise_or.at(words, at, masks_of(h))
    return words


def holds(words: np.ndarray, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    masks = masks_of(h)
    return (words[at] & masks == masks).all(axis=1)


def _unsigned(column) -> np.ndarray:
    return np.asarray(column, np.int64).view(np.uint64)


def build_filter(listed: DataFrame, keys: int) -> DataFrame:
    """(shard, words) of ``listed.h``, one row per shard that holds a key."""
    blocks = block_count(keys)

    def shard_of(batches):
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "shard": blocks_of(_unsigned(b["h"]), blocks) // BLOCKS_PER_SHARD})

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        h, first = _unsigned(rows["h"]), int(key[0]) * BLOCKS_PER_SHARD
        words = fill(h, blocks_of(h, blocks) - first, min(BLOCKS_PER_SHARD, blocks - first))
        return pd.DataFrame({"shard": [key[0]], "words": [words.tobytes()]})

    return (listed.select("h").mapInPandas(shard_of, "h long, shard long")
            .groupBy("shard").applyInPandas(build, "shard long, words binary"))


def _collected(shards: DataFrame, blocks: int) -> np.ndarray:
    """All words; the caller has checked their size."""
    words = np.zeros((blocks, WORDS_PER_BLOCK), np.uint64)
    for row in shards.toLocalIterator():
        part = np.frombuffer(row["words"], np.uint64).reshape(-1, WORDS_PER_BLOCK)
        first = row["shard"] * BLOCKS_PER_SHARD
        words[first:first + len(part)] = part
    return words


# -- the operator -----------------------------------------------------------

def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def listed_keys(rules: DataFrame, listed: DataFrame, url_col: str = "url") -> DataFrame:
    """(key, h, rule, verdict) of rules (host, path, verdict) and of URLs to block, each key once."""
    def of_rules(batches):
        for b in batches:
            rows = [(rule_key(h, p), f"{h}{p}", v) for h, p, v in zip(*(b.column(i).to_pylist() for i in range(3))) if h]
            yield _listing(rows)

    def of_urls(batches):
        for b in batches:
            yield _listing([(k, None, "block") for u in b.column(0).to_pylist() if (k := url_key(u))])

    schema = "key string, h long, rule string, verdict string"
    both = rules.select("host", F.coalesce("path", F.lit("")), "verdict").mapInArrow(of_rules, schema) \
        .unionAll(listed.select(F.col(f"`{url_col}`").cast("string")).mapInArrow(of_urls, schema))
    return both.groupBy("key", "h").agg(F.max("rule").alias("rule"), F.max("verdict").alias("verdict"))


def _listing(rows: list[tuple]) -> pa.RecordBatch:
    keys = [r[0] for r in rows]
    h = np.array([key_hash(k) for k in keys], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.string()), pa.array(h), pa.array([r[1] for r in rows], pa.string()),
         pa.array([r[2] for r in rows], pa.string())], names=["key", "h", "rule", "verdict"])


def judge_urls(spark: SparkSession, pages: DataFrame, rules: DataFrame, listed: DataFrame, url_col: str = "url",
               most_broadcast: int = MOST_BROADCAST,
               names: tuple[str, str, str, str] = ("host", "path", "rule", "verdict")) -> DataFrame:
    """``pages`` and four columns called ``names``: host, path, the deciding rule (or null), allow or block.

    ``rules``: host, path, verdict; ``listed``: column ``url`` of URLs to block. Give only the columns
    that are wanted of ``pages``: those of possible hits go through a shuffle.
    """
    entries = stash(spark, listed_keys(rules, listed), "url-listed")
    n = entries.count()
    blocks = block_count(n)
    shards = stash(spark, build_filter(entries, n), "url-filter")
    # Metadata of the list: how long the paths of rules are, and how many labels their hosts have.
    shape = rules.where(F.col("host") != "").agg(
        F.collect_set(F.length(F.coalesce("path", F.lit("")))), F.max(F.size(F.split("host", "[.]")))).first()
    lengths, depth = sorted(shape[0]), shape[1] or 0
    whole = blocks * WORDS_PER_BLOCK * 8 <= most_broadcast
    sent = spark.sparkContext.broadcast(_collected(shards, blocks)) if whole else None
    columns = pages.columns
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in columns], F.lit(0).alias("__none")).alias("page"),
                          F.col(f"`{url_col}`").cast("string").alias("url"))

    def offer(batches):
        for whole_batch in batches:
            for lo in range(0, whole_batch.num_rows, SLICE_ROWS):
                b = whole_batch.slice(lo, SLICE_ROWS)
                urls = b.column("url").to_pylist()
                split = [split_url(u) for u in urls]
                keys = [offered_keys(u, host, path, lengths, depth) for u, (host, path, _) in zip(urls, split)]
                flat = [k for ks in keys for k in ks]
                h = np.array([key_hash(k) for k in flat], np.uint64)
                may = holds(sent.value, h, blocks_of(h, blocks)) if sent is not None and flat else np.ones(len(flat), bool)
                upto = np.r_[0, np.cumsum([len(ks) for ks in keys])]
                kept = np.r_[0, np.cumsum(may)][upto].astype(np.int32)
                hits = pa.StructArray.from_arrays(
                    [pa.array([k for k, m in zip(flat, may) if m], pa.string()), pa.array(h[may].view(np.int64))],
                    names=["key", "h"])
                yield pa.RecordBatch.from_arrays(
                    [b.column("page"), pa.array([s[0] for s in split], pa.string()),
                     pa.array([s[1] for s in split], pa.string()), pa.ListArray.from_arrays(pa.array(kept), hits)],
                    names=["page", "host", "path", "hits"])

    hit = T.StructType([T.StructField("key", T.StringType()), T.StructField("h", T.LongType())])
    schema = T.StructType([packed.schema["page"], T.StructField("host", T.StringType()),
                           T.StructField("path", T.StringType()), T.StructField("hits", T.ArrayType(hit))])
    # Written, so that row numbers stay and the probe is not repeated.
    offered = stash(spark, packed.mapInArrow(offer, schema)
                    .withColumn("n", F.monotonically_increasing_id()), "url-offered")
    maybe = F.size("hits") > 0
    possible = offered.where(maybe).select("n", F.explode("hits").alias("x")).select("n", "x.key", "x.h")
    if not whole:
        possible = possible.join(_found_by_shard(possible.select("h").distinct(), shards, blocks), "h")
    exact = entries.drop("h")
    side = F.broadcast(exact) if n <= BROADCAST_ROWS else exact.hint("shuffle_hash")
    longest = F.struct(F.length("rule"), F.length(F.split_part("rule", F.lit("/"), F.lit(1))), "rule", "verdict")
    best = (possible.select("n", "key").join(side, "key")
            .groupBy("n").agg(F.max(F.when(F.col("rule").isNotNull(), longest)).alias("top"),
                              F.max(F.col("rule").isNull()).alias("listed")))

    def shown(df: DataFrame, rule: Column, verdict: Column) -> DataFrame:
        return df.select(*[F.col("page").getField(c).alias(c) for c in columns], F.col("host").alias(names[0]),
                         F.col("path").alias(names[1]), rule.alias(names[2]), verdict.alias(names[3]))

    judged = shown(offered.where(maybe).join(best, "n", "left"), F.col("top.rule"),
                   F.coalesce("top.verdict", F.when(F.col("listed"), "block").otherwise("allow")))
    rest = shown(offered.where(~maybe), F.lit(None).cast("string"), F.lit("allow"))
    return judged.unionByName(rest)


def _found_by_shard(hashes: DataFrame, shards: DataFrame, blocks: int) -> DataFrame:
    """Those of the distinct ``hashes.h`` that the filter holds, asked shard by shard."""
    def deal(batches):
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "shard": blocks_of(_unsigned(b["h"]), blocks) // BLOCKS_PER_SHARD})

    def ask(key: tuple, rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(shard):
            return pd.DataFrame({"h": pd.Series(dtype="int64")})
        h = _unsigned(rows["h"])
        words = np.frombuffer(shard["words"][0], np.uint64).reshape(-1, WORDS_PER_BLOCK)
        found = holds(words, h, blocks_of(h, blocks) - int(key[0]) * BLOCKS_PER_SHARD)
        return pd.DataFrame({"h": rows["h"].to_numpy()[found]})

    dealt = hashes.mapInPandas(deal, "h long, shard long")
    return dealt.groupBy("shard").cogroup(shards.groupBy("shard")).applyInPandas(ask, "h long")


def production_list(pages: DataFrame) -> DataFrame:
    """URLs of hosts of which a word between dots and hyphens is one of ``LISTED_WORDS``."""
    host = F.lower(F.regexp_extract("url", r"^.*?://([^/?#]*)", 1))
    return pages.where(F.arrays_overlap(F.split(host, "[.-]"), F.array(*[F.lit(w) for w in LISTED_WORDS]))).select("url")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = judge_urls(spark, pages, rule_table(spark), production_list(pages))
    return found.select("page_id", "host", "path", "rule", "verdict")


OP13_SQL = r"""
WITH cut AS (SELECT page_id, translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (SELECT c.page_id, r.h || r.p AS rule, r.v FROM cut c JOIN rules r
    ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.p)),
best AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(v, length(rule)) AS v FROM fits GROUP BY page_id)
SELECT c.page_id, c.host, c.path, b.rule, coalesce(b.v,
    CASE WHEN regexp_matches(c.host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM cut c LEFT JOIN best b ON c.page_id = b.page_id
"""
