"""File readers (SRC-1..6).

Everything is read as text first, with explicit string schemas: the files
are administrative exports whose types cannot be trusted, so inference is
never used (it would also turn postal codes into numbers).

The driver only touches metadata here: the file list and the first line of
each file, which one distributed job reads, and for large quoted files one
flag per split. All rows are parsed by tasks.
"""

from __future__ import annotations

import csv
import re
from functools import reduce
from typing import Iterable, Mapping, NamedTuple, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sunlight.sources.records import parse_records, read_records, splittable

# --- fixed values: text tokens pandas reads as missing by default ----------
PANDAS_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# ---------------------------------------------------------------------------

_ONE_COLUMN_SEP = "\u0001"
# Quoted files up to this size are parsed by one task each; larger ones are split.
WHOLE_FILE_BYTES = 64 << 20


def _regex_literal(sep: str) -> str:
    """Escape a field separator for ``split`` (which takes a Java regex)."""
    return "".join("\\" + ch if ch in ".$|()[]{}^?*+\\" else ch for ch in sep)


def _string_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def list_files(spark: SparkSession, paths: "str | Sequence[str]") -> list[str]:
    """Expand globs/directories into the file list (file index metadata only)."""
    return sorted(unquote(f) for f in spark.read.format("text").load(paths).inputFiles())


def _same_path(path: str) -> str:
    """Paths as listed and as reported by the scan differ in the slashes of their scheme."""
    return re.sub(r"^(\w+):/+", r"\1:/", path)


def first_lines(spark: SparkSession, files: Sequence[str], encoding: str = "UTF-8") -> dict[str, str]:
    """First non-empty line of each file, read by one job with one task per file.

    A task stops after its file's first line, so the job costs one block per
    file whatever the file sizes. Files without a line are left out.
    """
    # A session of its own, so that settings of the caller's stay as they are: one file per task.
    own = spark.newSession()
    for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(k, str(1 << 50))

    def head(batches):
        for b in batches:
            if len(b):
                yield b.head(1)
                return

    rows = (_lines_of(own, list(files), encoding)
            .select(F.col("_metadata.file_path").alias("path"), "line")
            .mapInPandas(head, "path string, line string").collect())
    found = {_same_path(unquote(r["path"])): r["line"] for r in rows}
    return {f: found[_same_path(f)] for f in files if _same_path(f) in found}


def to_split(spark: SparkSession, files: Sequence[str], encoding: str, multi_line: bool,
             whole_file_bytes: int) -> set[str]:
    """Those of ``files`` whose quoted records are to be read in several splits."""
    if not multi_line or not splittable(encoding):
        return set()
    sizes = {_same_path(unquote(r["path"])): r["length"]
             for r in spark.read.format("binaryFile").load(list(files)).select("path", "length").collect()}
    return {f for f in files if sizes.get(_same_path(f), 0) > whole_file_bytes}


def _fields(line: str, sep: str, quote: str | None = '"') -> list[str]:
    line = line.removeprefix("\ufeff").removesuffix("\r")
    if not quote:
        return line.split(sep)
    return next(csv.reader([line], delimiter=sep, quotechar=quote), [])


def headers_of(spark: SparkSession, files: Sequence[str], sep: str, encoding: str = "UTF-8") -> dict[str, tuple]:
    """Column names of each file that has a first line."""
    return {f: tuple(_fields(line, sep)) for f, line in first_lines(spark, files, encoding).items()}


def _csv_reader(spark: SparkSession, sep: str, encoding: str, multi_line: bool):
    """RFC 4180 quoting: a doubled quote is a quote, a backslash is itself, and a
    quoted field may hold separators and (with ``multi_line``) line breaks."""
    return (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
            .option("quote", '"').option("escape", '"').option("multiLine", multi_line))


def read_text_csv(spark: SparkSession, paths: "str | Sequence[str]", sep: str = ",",
                  encoding: str = "UTF-8", multi_line: bool = True,
                  whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """SRC-1: CSV with a header line, every column read as text.

    ``multi_line`` keeps records whose quoted fields hold line breaks whole: a file of up to
    ``whole_file_bytes`` is parsed by one task, a larger one is split (``records.read_records``).
    Turn it off for files known to have no line breaks in fields, which saves a pass over them.
    Several files must have the same header; use ``read_csv_union_by_name`` for files that drift.
    """
    files = list_files(spark, paths)
    large = to_split(spark, files, encoding, multi_line, whole_file_bytes)
    if len(files) > 1 or large:
        headers = headers_of(spark, files, sep, encoding)
        if len(set(headers.values())) > 1:
            raise ValueError(f"files with different headers: {headers}; use read_csv_union_by_name")
    if not large:
        return _csv_reader(spark, sep, encoding, multi_line).option("inferSchema", False).csv(paths)
    names = next(iter(headers.values()))
    out = parse_records(read_records(spark, sorted(large), sep, encoding).records, names, sep, '"').drop("key")
    small = [f for f in files if f not in large]
    return out.unionByName(_csv_reader(spark, sep, encoding, multi_line).schema(_string_schema(names)).csv(small)) \
        if small else out


def lower_columns(df: DataFrame) -> DataFrame:
    """PRJ-4: rename every column to lower case; refuse silent collisions."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"columns collide once lower-cased: {df.columns}")
    return df.toDF(*lowered)


class CsvRead(NamedTuple):
    rows: DataFrame       # the records that fit their file's header
    rejected: DataFrame   # file, record: those that do not


_BAD = "_rejected_record"


def read_csv_union(spark: SparkSession, paths: "str | Sequence[str]", sep: str = ";", encoding: str = "UTF-8",
                   lower: bool = True, multi_line: bool = True,
                   headers: Mapping[str, Sequence[str]] | None = None,
                   whole_file_bytes: int = WHOLE_FILE_BYTES) -> CsvRead:
    """SRC-2: many CSV files whose headers drift; align columns by name.

    Files are grouped by their exact header; each group is one distributed
    read with an explicit all-text schema. Groups are combined with
    ``unionByName(allowMissingColumns=True)``. Records whose field count differs
    from their file's header are not lost: they are the second frame, with their
    file and text, to be counted or written. ``headers`` (file to column names)
    saves the job that reads first lines where a manifest is at hand. ``multi_line``
    and ``whole_file_bytes`` are those of ``read_text_csv``.

    CSV column pruning is switched off for these reads so that which records are
    rejected does not depend on the columns a later query selects. A single
    glob read would apply the first file's header to every file by position and
    silently shift columns; this never does that.
    """
    files = list_files(spark, paths)
    known = {f: tuple(h) for f, h in headers.items()} if headers else headers_of(spark, files, sep, encoding)
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        if f in known:
            groups.setdefault(known[f], []).append(f)
    if not groups:
        raise FileNotFoundError(f"no input lines under {paths!r}")
    large = to_split(spark, files, encoding, multi_line, whole_file_bytes)
    rows, rejected = [], []
    for header, group in groups.items():
        if len(set(header)) != len(header):
            raise ValueError(f"repeated column names in {group[0]}: {header}")
        split = [f for f in group if f in large]
        if split:
            found = read_records(spark, split, sep, encoding)
            parsed = parse_records(found.records, header, sep, '"', _BAD)
            rows.append(parsed.where(F.col(_BAD).isNull()).drop(_BAD, "key"))
            rejected.append(parsed.where(F.col(_BAD).isNotNull()).join(found.splits, "key")
                            .select("file", F.col(_BAD).alias("record")))
        whole = [f for f in group if f not in large]
        if not whole:
            continue
        read = (_csv_reader(spark, sep, encoding, multi_line)
                .schema(T.StructType([*_string_schema(header), T.StructField(_BAD, T.StringType(), True)]))
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
                .option("columnPruning", False).option("enforceSchema", True).csv(whole))
        # The test names a data column too: a scan of the record column alone is refused.
        bad = F.concat(F.col(_BAD), F.coalesce(F.col(f"`{header[0]}`"), F.lit("")))
        rows.append(read.where(bad.isNull()).drop(_BAD))
        rejected.append(read.where(bad.isNotNull()).select(
            F.col("_metadata.file_path").alias("file"), F.col(_BAD).alias("record")))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return CsvRead(lower_columns(out) if lower else out, reduce(lambda a, b: a.unionByName(b), rejected))


def read_csv_union_by_name(spark: SparkSession, paths: "str | Sequence[str]", sep: str = ";",
                           encoding: str = "UTF-8", lower: bool = True, multi_line: bool = True,
                           headers: Mapping[str, Sequence[str]] | None = None,
                           whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """The rows of ``read_csv_union``; use that one to see what was rejected."""
    return read_csv_union(spark, paths, sep, encoding, lower, multi_line, headers, whole_file_bytes).rows


def _positional(arr, columns: Mapping[int, str], na_values: Iterable[str]):
    na = list(na_values)
    cols = []
    for idx, name in columns.items():
        v = F.get(arr, idx)
        if na:
            v = F.when(v.isin(na), F.lit(None).cast("string")).otherwise(v)
        cols.append(v.alias(name))
    return cols


def _lines_of(spark: SparkSession, path: "str | Sequence[str]", encoding: str) -> DataFrame:
    """Each non-empty line as one text column, decoded with ``encoding`` (the plain
    ``text`` source ignores encodings), quoting off."""
    return (spark.read.schema("line string").option("sep", _ONE_COLUMN_SEP)
            .option("quote", "").option("escape", "").option("header", False)
            .option("encoding", encoding).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(path)
            .where(F.col("line").isNotNull()))


def read_lines(spark: SparkSession, path: "str | Sequence[str]", encoding: str) -> DataFrame:
    """The non-empty lines of text files, without their line ends."""
    return _lines_of(spark, path, encoding).select(F.regexp_replace("line", "\r$", "").alias("line"))


def _widths(spark: SparkSession, path, encoding: str, sep: str, quote: str | None) -> dict[int, list[str]]:
    """Files by the field count of their first line."""
    groups: dict[int, list[str]] = {}
    for f, line in first_lines(spark, list_files(spark, path), encoding).items():
        groups.setdefault(len(_fields(line, sep, quote)), []).append(f)
    if not groups:
        raise ValueError(f"no non-empty file under {path!r}")
    return groups


def _tolerant(spark: SparkSession, paths, columns, encoding, sep, width, na_values) -> DataFrame:
    arr = F.split(F.col("line"), _regex_literal(sep), -1)
    return (read_lines(spark, paths, encoding).where(F.col("line") != "")
            .select(arr.alias("f"))
            .where(F.size("f") <= width)
            .select(*_positional(F.col("f"), columns, na_values)))


def _tolerant_quoted(spark: SparkSession, paths, columns, encoding, sep, width, na_values, quote,
                     multi_line, whole_file_bytes) -> DataFrame:
    names = [f"_c{i}" for i in range(width)]
    files = list_files(spark, paths)
    large = to_split(spark, files, encoding, multi_line, whole_file_bytes)
    # Fields of a record that does not fit: its separators outside quotes, and one.
    q = _regex_literal(quote)
    bare = F.regexp_replace(_BAD, f"{q}[^{q}]*+{q}", "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1

    def fitting(read: DataFrame) -> DataFrame:
        kept = read.where(F.concat(F.col(_BAD), F.coalesce("_c0", F.lit(""))).isNull() | (fields <= width))
        return kept.select(*_positional(F.array(*names), columns, na_values))

    small, out = [f for f in files if f not in large], []
    if small:
        out.append(fitting(
            spark.read.schema(T.StructType([*_string_schema(names), T.StructField(_BAD, T.StringType(), True)]))
            .option("header", False).option("sep", sep).option("encoding", encoding)
            .option("quote", quote).option("escape", quote).option("multiLine", multi_line)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
            .option("columnPruning", False).csv(small)))
    if large:
        records = read_records(spark, sorted(large), sep, encoding, quote, header=False).records
        out.append(fitting(parse_records(records, names, sep, quote, _BAD)))
    return reduce(lambda a, b: a.unionByName(b), out)


def read_tolerant_tsv(spark: SparkSession, path: "str | Sequence[str]", columns: Mapping[int, str],
                      encoding: str = "ISO-8859-1", sep: str = "\t",
                      width: int | None = None,
                      na_values: Iterable[str] = PANDAS_NA_VALUES, quote: str | None = '"',
                      multi_line: bool = True, whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """SRC-4: headerless tab-separated files with a tolerant row policy.

    The expected width of each file is the field count of its first line
    (or ``width`` for all). Longer lines are skipped, shorter lines are
    padded with NULL, and tokens listed in ``na_values`` become NULL.
    Columns are picked by position and renamed (``columns = {position:
    name}``). A field that begins with ``quote`` may hold separators, doubled
    quotes and (with ``multi_line``) line breaks; files over ``whole_file_bytes``
    are split all the same. ``quote=None`` takes quotes as they are. First
    lines are read by one job, files are grouped by width, and each group is one
    distributed read.
    """
    groups = {width: path} if width is not None else _widths(spark, path, encoding, sep, quote)
    frames = [_tolerant_quoted(spark, fs, columns, encoding, sep, w, na_values, quote, multi_line, whole_file_bytes)
              if quote else _tolerant(spark, fs, columns, encoding, sep, w, na_values) for w, fs in groups.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def _strict(spark: SparkSession, paths, columns, width, encoding, sep) -> DataFrame:
    names = [f"_c{i}" for i in range(width)]
    df = (spark.read.schema(_string_schema(names)).option("sep", sep)
          .option("quote", "").option("header", False).option("encoding", encoding)
          .option("mode", "FAILFAST").option("columnPruning", False).csv(paths))
    return df.select(*[F.col(f"_c{i}").alias(n) for i, n in columns.items()])


def read_headerless_tsv(spark: SparkSession, path: "str | Sequence[str]", columns: Mapping[int, str],
                        width: int | None = None, encoding: str = "UTF-8",
                        sep: str = "\t") -> DataFrame:
    """SRC-3: strict headerless tab-separated scan, quoting off.

    Every line must have its file's width (the first line's field count, or
    ``width`` for all files); anything else fails the job, as the strict
    reader it mirrors does. Files are grouped by width, one read per group.
    """
    groups = {width: path} if width is not None else _widths(spark, path, encoding, sep, None)
    frames = [_strict(spark, fs, columns, w, encoding, sep) for w, fs in groups.items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_geo_points(spark: SparkSession, path: str, sep: str = ";",
                    postal_col: str = "Code Postal", point_col: str = "geo_point_2d",
                    encoding: str = "UTF-8") -> DataFrame:
    """SRC-5: postal-code / coordinate reference file. The postal code stays
    text so that codes such as '2A004' or '01000' survive."""
    df = read_text_csv(spark, path, sep=sep, encoding=encoding)
    return df.select(F.col(f"`{postal_col}`").alias(postal_col), F.col(point_col))


def spread(df: DataFrame, min_partitions: int | None = None,
           keys: Sequence[str] = ()) -> DataFrame:
    """Give a scan at least ``min_partitions`` partitions (default: the
    session's default parallelism).

    A file scan is split by row groups; an input stored as one large row
    group is read by a single task, and every narrow operator above it
    (joins against broadcast sides, parsing, partial aggregation) then runs
    on one core. Such a scan is repartitioned: by hash of ``keys`` when
    given (deterministic under task retries without a local sort; pick a
    high-cardinality key), round-robin otherwise. A scan that already has
    enough splits - any large input - is returned unchanged, so no shuffle
    is added where the data is big. Only the split count is inspected
    (planning metadata, no job).
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


def read_tables(spark: SparkSession, base: str, names: Iterable[str],
                min_partitions: int | None = None) -> dict[str, DataFrame]:
    """SRC-6: several Parquet tables at once, each spread over at least
    ``min_partitions`` tasks (see ``spread``)."""
    return {n: spread(spark.read.parquet(f"{base}/{n}.parquet"), min_partitions) for n in names}


def register_views(frames: Mapping[str, DataFrame]) -> list[str]:
    """SRC-9: expose DataFrames (raw files, marts) as temporary views so the
    same data can be queried with ``spark.sql``; returns the view names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return list(frames)
