"""A stored index for the single-term search (QRY-1 without a scan).

``build_search_index`` stores the recipient mart in parts by a hash of the name,
and beside it the keys under which names and cities are found: for every different (name,
part) the grams of the name, for every (city, part) the start of the city. Keys lie
in buckets by their hash, one folder each, with a table of how many names have a gram.

A term reads the counts of its grams, then the bucket of its rarest one, which names the
parts with a matching name or city; only these parts are read, and the full condition is checked
on their rows. A term with wildcards uses the letters between them; if these
hold no gram, all parts are read.
"""

from __future__ import annotations

import json
import os
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sunlight.functions import escape_like
from sunlight.plans.search import CITY_START, SHORT_GRAM, GRAM, _name_keys, search_recipients
from sunlight.sinks.versioned import commit_version, current_version, row_count, write_observed

BUCKETS, PARTS = 256, 64
NAME, CITY = "n", "c"                     # kinds of keys
KEYS = "kind string, key string, value string, _part int, _bucket int"
COUNTS = "key string, names long, _bucket int"


def _bucket(kind: Column, key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(kind, key), F.lit(buckets)).cast("int")


def build_search_index(recipients: DataFrame, path: str, parts: int = PARTS, buckets: int = BUCKETS) -> dict:
    """Create or replace the index at ``path``; returns its figures (rows, keys). ``parts`` grows with the
    mart (a part should be a few files), ``buckets`` with the number of different names."""
    spark = recipients.sparkSession
    version = f"v-{os.urandom(8).hex()}"
    base = os.path.join(path, version)
    part = F.pmod(F.xxhash64(F.lower(F.coalesce("nom", F.lit("")))), F.lit(parts)).cast("int")
    rows = write_observed(recipients.withColumn("_part", part).repartition("_part").sortWithinPartitions("_part", "nom"),
                          os.path.join(base, "rows"), ["_part"], row_count())
    schema = T.StructType([*recipients.schema.fields, T.StructField("_part", T.IntegerType())])
    stored = spark.read.schema(schema).parquet(rows.path)
    names = stored.select(F.lower("nom").alias("value"), "_part").where("value <> ''").distinct()
    cities = stored.select(F.lower("ville").alias("value"), "_part").where("value <> ''").distinct()
    keys = names.select(F.lit(NAME).alias("kind"), F.explode(_name_keys(F.col("value"))).alias("key"), "value", "_part") \
        .unionAll(cities.select(F.lit(CITY), F.substring("value", 1, CITY_START), "value", "_part")) \
        .withColumn("_bucket", _bucket(F.col("kind"), F.col("key"), buckets))
    written = write_observed(keys.repartition("_bucket").sortWithinPartitions("_bucket", "kind", "key"),
                             os.path.join(base, "keys"), ["_bucket"], row_count())
    counts = spark.read.schema(KEYS).parquet(written.path).where(F.col("kind") == NAME).groupBy("_bucket", "key").agg(F.count(F.lit(1)).alias("names"))
    write_observed(counts.repartition("_bucket"), os.path.join(base, "counts"), ["_bucket"])
    spark.createDataFrame([(parts, buckets, schema.json())], "parts int, buckets int, rows string").write.parquet(os.path.join(base, "shape"))
    commit_version(spark, path, version)
    return {"rows": rows.metrics["rows"], "keys": written.metrics["rows"]}


class Lookup(NamedTuple):
    keys: DataFrame            # the keys read: only the term's buckets
    parts: list[int]           # parts that hold a matching name or city
    rows: DataFrame            # the recipients of these parts


def _grams_of(term: str, literal: bool) -> list[str]:
    """Grams that every name matching the term has: those of the runs between its wildcards."""
    runs = [term] if literal else re.split("[%_]", term)
    out = set()
    for r in runs:
        n = GRAM if len(r) >= GRAM else SHORT_GRAM
        out |= {r[i:i + n] for i in range(len(r) - n + 1)}
    return sorted(out)


def look_up(spark: SparkSession, path: str, q: str, literal: bool = False, min_len: int = 2) -> Lookup:
    """What the index reads for one term."""
    base = current_version(spark, path)
    table = lambda name, schema: spark.read.schema(schema).parquet(os.path.join(base, name))
    # Lower case as the table has it, not as Python does.
    shape = spark.read.parquet(os.path.join(base, "shape")).select("*", F.lower(F.lit(q)).alias("term")).first()
    keys, rows = table("keys", KEYS), table("rows", T.StructType.fromJson(json.loads(shape["rows"])))
    if len(q) < min_len:
        return Lookup(keys.where("false"), [], rows.where("false").drop("_part"))
    buckets, term = shape["buckets"], shape["term"]
    grams, by_city = _grams_of(term, literal), len(q) > 3
    start = term[:CITY_START]
    if not grams or by_city and not literal and re.search("[%_]", start):
        parts = list(range(shape["parts"]))
        return Lookup(keys, parts, rows.drop("_part"))
    asked = spark.createDataFrame([(NAME, g) for g in grams] + [(CITY, start)], "kind string, key string").select(
        "kind", "key", _bucket(F.col("kind"), F.col("key"), buckets).alias("bucket")).collect()
    bucket = {(r["kind"], r["key"]): r["bucket"] for r in asked}
    found = {r["key"]: r["names"] for r in table("counts", COUNTS).where(
        F.col("_bucket").isin(sorted({b for (kind, _), b in bucket.items() if kind == NAME})) & F.col("key").isin(grams)).collect()}
    rarest = min(grams, key=lambda g: (found.get(g, 0), g))
    pattern, value = escape_like(q, literal), F.col("value")
    hit = (F.col("kind") == NAME) & (F.col("key") == rarest) & value.ilike(f"%{pattern}%")
    read = {bucket[NAME, rarest]}
    if by_city:
        hit = hit | (F.col("kind") == CITY) & (F.col("key") == start) & value.ilike(f"{pattern}%")
        read.add(bucket[CITY, start])
    hits = keys.where(F.col("_bucket").isin(sorted(read))).where(hit)
    parts = sorted(r[0] for r in hits.select("_part").distinct().collect())      # at most as many as the index has
    return Lookup(hits, parts, rows.where(F.col("_part").isin(parts)).drop("_part"))


def search_index(spark: SparkSession, path: str, q: str, regions: DataFrame, influence: DataFrame,
                 top_products: DataFrame, k: int = 15, literal: bool = False, min_len: int = 2) -> DataFrame:
    """QRY-1 over a stored index: the rows of ``search_recipients``, reading the term's part of the tables only."""
    found = look_up(spark, path, q, literal, min_len)
    return search_recipients(found.rows, regions, influence, top_products, q, k, literal, min_len)
