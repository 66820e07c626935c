"""Sharding by sampled splitters, sizes near equal (law ``bytes``).

Records are ordered by (hash of the text, doc_id, row): equal texts are
neighbours, and a group of copies larger than a range is subdivided by its
ids. A key sample in which a record's chance is its size is drawn; its
quantiles are the splitters, and a binary search over them deals each record
to one of ``ranges`` ranges. Ranges of equal bytes may hold very different numbers of records (a third
of all rows may have no text, and so hardly any bytes): a range with over twice the even
number of rows is subdivided at quantiles of a sample of its rows. Exact range sizes then place each range on the
line of all bytes; the ``shards`` equal cuts of that line subdivide every
range that reaches over one. Inside a range a running sum gives each record
its place, so all sorting is by range (about 1/``ranges`` of the data) and no
step sorts or counts a shard as a whole.

Only DataFrame functions are used. The driver sees the total, the rows of each range and the samples
(``SAMPLED`` keys per range on average, whatever the input) and nothing else;
the one broadcast is a table of at most 2 x ``ranges`` + ``shards`` rows.

Defined cases: a null text has no bytes, so size 1, and the checksum of the
empty text. Repeated rows and null ids are records like any other. An empty
table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import doc_key, from_key, stash, table

SHARDS = 16
SAMPLED = 16
ROWS_PER_RANGE = 50_000
LEAST_RANGES, MOST_RANGES = 64, 4096


def _searched(splitters: list[tuple[int, int, int]]):
    """Column: how many splitters are not after the record's key, by binary search."""
    if not splitters:
        return F.lit(0)
    fixed = F.array(*[F.struct(F.lit(h).cast("long").alias("h"), F.lit(d).cast("long").alias("doc"),
                               F.lit(r).cast("long").alias("row_id")) for h, d, r in splitters])
    step, steps = 1, []
    while step <= len(splitters):
        steps.append(step)
        step *= 2
    key = F.struct("h", "doc", "row_id")
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0),
        lambda at, s: F.when((at + s <= F.lit(len(splitters))) & (F.get(fixed, at + s - 1) <= key), at + s)
        .otherwise(at))


def sample_splitters(records: DataFrame, total: int, ranges: int, sampled: int = SAMPLED) -> list[tuple]:
    """``ranges`` - 1 quantiles of a size-weighted key sample of ``records``.

    A record is drawn as often as marks of an even grid of ``ranges`` x ``sampled``
    over the total fall into its bytes, with a chance for the remainder.
    """
    drawn = F.col("size") * F.lit(ranges * sampled) / F.lit(max(1, total))
    chance = F.pmod(F.xxhash64("h", "doc", "row_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    hits = records.withColumn("draws", F.floor(drawn + chance).cast("long")).where("draws > 0")
    keys = hits.select("h", "doc", "row_id", "draws").orderBy("h", "doc", "row_id").collect()
    marks, seen, each = [], 0, sampled
    for k in keys:                       # about ranges x sampled rows
        seen += k["draws"]
        if seen >= each:
            marks.append((k["h"], k["doc"], k["row_id"]))
            each = (seen // sampled + 1) * sampled
    return marks[:-1] if len(marks) >= ranges else marks


def subdivide(records: DataFrame, splitters: list[tuple], count: int, ranges: int, sampled: int = SAMPLED) -> list[tuple]:
    """``splitters`` with more of them inside every range of over twice the even number of rows.

    Such a range gets a splitter for each even share of its rows, at quantiles of a sample
    of its keys; all together are at most ``ranges`` more.
    """
    even = max(1, -(-count // ranges))
    rows = {r["range"]: r["count"] for r in records.groupBy(_searched(splitters).alias("range")).count().collect()}
    overfull = {k: n for k, n in rows.items() if n > 2 * even}
    if not overfull:
        return splitters
    # Every row has the same chance; a row of an overfull range is drawn ``sampled`` times per even share.
    chance = F.pmod(F.xxhash64("row_id", "doc", "h", F.lit("rows")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = records.where(chance < sampled / even).withColumn("range", _searched(splitters)) \
        .where(F.col("range").isin(list(overfull))).select("range", "h", "doc", "row_id").orderBy("h", "doc", "row_id").collect()
    more, seen = [], {}
    for k in drawn:                      # about ranges x sampled rows at most
        seen[k["range"]] = seen.get(k["range"], 0) + 1
        if seen[k["range"]] % sampled == 0:
            more.append((k["h"], k["doc"], k["row_id"]))
    return sorted({*splitters, *more})


def shard_by_bytes(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id",
                   text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    records = stash(spark, docs.select(
        doc_key(id_col).alias("doc"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"), F.xxhash64(text).alias("h"),
        F.monotonically_increasing_id().alias("row_id")), "shard-records")
    count, total = records.agg(F.count(F.lit(1)), F.sum("size")).first()
    ranges = ranges or min(MOST_RANGES, max(LEAST_RANGES, -(-count // ROWS_PER_RANGE)))
    splitters = subdivide(records, sample_splitters(records, total or 0, ranges), count, ranges)
    dealt = records.withColumn("range", _searched(splitters))

    in_range = Window.partitionBy("range").orderBy("h", "doc", "row_id")
    running = dealt.withColumn("upto", F.sum("size").over(
        in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow))) \
        .withColumn("n", F.row_number().over(in_range))
    # At most 2 x ``ranges`` rows from here to the broadcast.
    sizes = dealt.groupBy("range").agg(F.sum("size").alias("bytes"))
    before = sizes.select("range", (F.sum("bytes").over(Window.orderBy("range")) - F.col("bytes")).alias("before"))
    # The middle of a record decides which equal cut of the line it is in.
    placed = stash(spark, running.join(F.broadcast(before), "range").withColumn(
        "shard", F.least(F.lit(shards - 1), F.expr(f"(2 * (before + upto) - size) * {int(shards)} "
                                                   f"div {2 * max(1, total or 1)}")).cast("int"))
        .select("doc", "size", "crc", "range", "shard", "n"), "shard-placed")
    # First number of each (range, shard), and how many of the shard lie in earlier ranges.
    runs = placed.groupBy("range", "shard").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("rows"))
    starts = runs.select("range", "shard", "first", (F.sum("rows").over(
        Window.partitionBy("shard").orderBy("range")) - F.col("rows")).alias("earlier"))
    return placed.join(F.broadcast(starts), ["range", "shard"]).select(
        from_key("doc").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), "shard",
        (F.col("earlier") + F.col("n") - F.col("first")).cast("long").alias("slot"))


def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_by_bytes(spark, docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
