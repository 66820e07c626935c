"""Splittable reading of quoted, multi-line text records.

A quoted field may hold line breaks, so whether a line break ends a record
depends on everything before it. Spark therefore parses such a file in one task.
Here a file is read by lines, in as many splits as its size gives:

1. Every line with a quote is a transition: whether a field is open after it, if one
   was open before, and if none was. The transitions of a split are composed in one
   pass that returns one row per split (a distributed job; the lines stay where
   they are).
2. Composing the splits of each file in order tells which begin inside a field.
3. A second pass joins the lines of each split to records. Records that cross the
   edge of a split are emitted in pieces, at most two per split, and put together
   by file and split; this pass runs only if there are any.

Quoting follows RFC 4180 as the record parser does: a quote opens a field only at its
start, a doubled quote is one, and what follows a closing quote belongs to the field
up to the next separator. The driver receives one flag per split.
"""

from __future__ import annotations

from typing import Mapping, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Of the encodings that Spark reads, those in which line breaks, quotes and separators are single ASCII bytes.
_ASCII_BASED = ("utf-8", "us-ascii", "iso-8859-1")


def splittable(encoding: str) -> bool:
    return encoding.lower() in _ASCII_BASED


def _lines(spark: SparkSession, files: Sequence[str], encoding: str) -> DataFrame:
    """file, start (of the split), line; in the order of the files within each split."""
    raw = spark.read.option("lineSep", "\n").text(list(files))
    line = F.make_valid_utf8("value") if encoding.lower() == "utf-8" else \
        F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                      line.alias("line"))


def _escaped(ch: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c.isascii() and c.isprintable() else c for c in ch)


def open_after(line: Column, sep: str, quote: str) -> tuple[Column, Column]:
    """Whether a quoted field is open after the line, if none was open before it, and if one was."""
    q, s = _escaped(quote), _escaped(sep)
    inside = f"(?:[^{q}]++|{q}{q})*+"
    junk = f"(?:(?!{s})[\\s\\S])*+"                                      # up to the next separator
    fields = f"(?:(?:{q}{inside}{q}{junk}|(?!{q}){junk}){s})*+"
    opens = f"{fields}{q}{inside}\\z"
    has_quote = F.contains(line, F.lit(quote))
    return (has_quote & line.rlike(f"\\A{opens}"),
            ~has_quote | line.rlike(f"\\A{inside}(?:\\z|{q}{junk}{s}{opens})"))


def states(a: np.ndarray, b: np.ndarray, before: bool) -> np.ndarray:
    """State after each line of a run of transitions (``a`` from closed, ``b`` from open)."""
    swaps = np.cumsum(a & ~b)
    settled = np.maximum.accumulate(np.where(a == b, np.arange(len(a)), -1))     # the last line that decides by itself
    known = settled >= 0
    at = np.where(known, settled, 0)
    return np.where(known, a[at], before) ^ ((swaps - np.where(known, swaps[at], 0)) & 1).astype(bool)


def _runs(key: np.ndarray):
    """(start, end) of the runs of equal keys."""
    cut = np.flatnonzero(key[1:] != key[:-1]) + 1
    return zip(np.r_[0, cut].tolist(), np.r_[cut, len(key)].tolist()) if len(key) else ()


def _flags(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


def split_states(lines: DataFrame, sep: str, quote: str) -> list[tuple[str, int, int, bool, bool]]:
    """(file, start, key, whether it begins inside a field, whether it ends so) of every split, in order."""
    a, b = open_after(F.col("line"), sep, quote)

    def compose(batches):
        last, row = None, None
        for batch in batches:
            key, a, b = batch.column(0).to_numpy(), _flags(batch.column(3)), _flags(batch.column(4))
            for lo, hi in _runs(key):
                if key[lo] != last:
                    if row:
                        yield pa.RecordBatch.from_pylist([row], schema=made)
                    last = key[lo]
                    row = {"key": int(last), "file": batch.column(1)[lo].as_py(), "start": batch.column(2)[lo].as_py(),
                           "from_closed": False, "from_open": True}
                row["from_closed"] = bool(states(a[lo:hi], b[lo:hi], row["from_closed"])[-1])
                row["from_open"] = bool(states(a[lo:hi], b[lo:hi], row["from_open"])[-1])
        if row:
            yield pa.RecordBatch.from_pylist([row], schema=made)

    made = pa.schema([("key", pa.int64()), ("file", pa.string()), ("start", pa.int64()), ("from_closed", pa.bool_()),
                      ("from_open", pa.bool_())])
    found = lines.select(_key(), "file", "start", a.alias("a"), b.alias("b")).mapInArrow(
        compose, "key long, file string, start long, from_closed boolean, from_open boolean").collect()
    out, file, inside = [], None, False
    for r in sorted(found, key=lambda r: (r["file"], r["start"])):
        inside = inside and r["file"] == file
        file = r["file"]
        after = r["from_open"] if inside else r["from_closed"]
        out.append((file, r["start"], r["key"], inside, after))
        inside = after
    return out


def _key() -> Column:
    return F.xxhash64("file", "start").alias("key")


class _Cutter:
    """Joins the lines of one split after the other to records.

    ``begun`` maps each split to (begins inside a field, begins its file).
    """

    def __init__(self, begun: Mapping[int, tuple[bool, bool]], header: bool, pieces: bool):
        self.begun, self.header, self.pieces = begun, header, pieces
        self.key = None

    def _start(self, key: int) -> None:
        if key not in self.begun:
            raise RuntimeError("the splits of the files changed between two passes (other cores or split size): "
                               "set spark.sql.files.minPartitionNum, or read again")
        self.key = key
        self.inside, first = self.begun[key]
        self.head, self.skip, self.waiting = self.inside, self.header and first, []

    def run(self, batches):
        for batch in batches:
            key, lines = batch.column(0).to_numpy(), batch.column(1)
            a, b = _flags(batch.column(2)), _flags(batch.column(3))
            for lo, hi in _runs(key):
                if key[lo] != self.key:
                    yield from self._tail()
                    self._start(int(key[lo]))
                yield from self._lines(lines.slice(lo, hi - lo), a[lo:hi], b[lo:hi])
        yield from self._tail()

    def _lines(self, lines, a, b):
        after = states(a, b, self.inside)
        self.inside = bool(after[-1])
        ends = np.flatnonzero(~after) + 1
        if not len(ends):
            self.waiting += lines.to_pylist()
            return
        done, rest = lines.slice(0, int(ends[-1])), lines.slice(int(ends[-1]))
        if len(ends) < len(done):
            done = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), done), "\n")
        start = 0
        if self.waiting or self.head:
            first = "\n".join([*self.waiting, done[0].as_py()])
            if self.head:
                if self.pieces:
                    yield self._piece(first, begins=False, ends=True)
                start = 1
            else:
                done = pa.concat_arrays([pa.array([first], pa.string()), done.slice(1)])
        self.head, self.waiting = False, rest.to_pylist()
        while self.skip and start < len(done):
            self.skip = done[start].as_py() in ("", "\r")
            start += 1
        if not self.pieces and start < len(done):
            done = done.slice(start)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(done), self.key, np.int64)), done], names=["key", "record"])

    def _tail(self):
        if self.key is not None and self.waiting and self.pieces:
            yield self._piece("\n".join(self.waiting), begins=not self.head, ends=False)

    def _piece(self, text: str, begins: bool, ends: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([self.key], pa.int64()), pa.array([begins]), pa.array([ends]), pa.array([text], pa.string())],
            names=["key", "begins", "ends", "text"])


class Records(NamedTuple):
    records: DataFrame      # key (of the split in which the record begins), record
    splits: DataFrame       # key, file, start: one row per split


def read_records(spark: SparkSession, files: Sequence[str], sep: str, encoding: str, quote: str = '"',
                 header: bool = True) -> Records:
    """Every non-empty record; with ``header`` the first of each file is left out."""
    lines = _lines(spark, files, encoding)
    found = split_states(lines, sep, quote)
    begun = {key: (inside, start == 0) for _, start, key, inside, _ in found}
    splits = spark.createDataFrame([(key, file, start) for file, start, key, *_ in found], "key long, file string, start long")
    states_of = spark.sparkContext.broadcast(begun)              # two flags per split
    a, b = open_after(F.col("line"), sep, quote)
    sent = lines.select(_key(), "line", a.alias("a"), b.alias("b"))

    def whole(batches):
        yield from _Cutter(states_of.value, header, pieces=False).run(batches)

    def pieces(batches):
        yield from _Cutter(states_of.value, header, pieces=True).run(batches)

    records = sent.mapInArrow(whole, "key long, record string")
    if any(after for *_, after in found):              # also where the last record of a file lacks its closing quote
        # A piece that begins a record comes after the one that ends another in the same split.
        in_order = Window.partitionBy("file").orderBy("start", "begins")
        cut = (sent.mapInArrow(pieces, "key long, begins boolean, ends boolean, text string")
               .join(splits, "key").withColumn("n", F.sum(F.col("begins").cast("int")).over(in_order)))
        records = records.unionByName(cut.groupBy("file", "n").agg(
            F.min_by("key", F.struct("start", "begins")).alias("key"),
            F.array_sort(F.collect_list(F.struct("start", "begins", "text"))).alias("p"))
            .select("key", F.array_join(F.col("p.text"), "\n").alias("record")))
    bare = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return Records(records.select("key", bare.alias("record")).where("record <> ''"), splits)


def parse_records(records: DataFrame, names: Sequence[str], sep: str, quote: str, rejected: str | None = None) -> DataFrame:
    """``key`` and the fields of ``record`` as text columns ``names``; ``rejected`` names a column for the
    text of records with another number of fields."""
    schema = ", ".join(f"_c{i} string" for i in range(len(names))) + (", _bad string" if rejected else "")
    options = {"sep": sep, "quote": quote, "escape": quote, "multiLine": "true", "mode": "PERMISSIVE"}
    if rejected:
        options["columnNameOfCorruptRecord"] = "_bad"
    parsed = records.select("key", F.from_csv("record", schema, options).alias("r"))
    return parsed.select("key", *[F.col(f"r._c{i}").alias(n) for i, n in enumerate(names)],
                         *([F.col("r._bad").alias(rejected)] if rejected else []))
