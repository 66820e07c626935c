"""All-or-nothing tables: a new version beside the old one, then one switch.

A table is a folder of versions, ``v-<id>``, each written once and never changed,
and a folder ``_commits`` of empty files, ``<number>.v-<id>``. The version of the
highest commit is the table. A job that fails midway leaves no commit, so readers keep
the version they had; a table may be replaced from itself; and a query that began on
an older version ends on it. Creating the commit file is the switch, one
operation of the file system (which must list what it has just created).

One writer at a time: of two that commit at once, the later number (or the greater
name) is the table, and the other's version stays in the folder.
"""

from __future__ import annotations

import os
import uuid
from typing import Mapping, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

COMMITS = "_commits"


class Written(NamedTuple):
    path: str                  # the folder of the version that was written
    metrics: dict              # figures observed while it was written


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def commits(spark: SparkSession, path: str) -> list[str]:
    """Names of the commits of a table, oldest first; empty if there is none."""
    fs, where = _fs(spark, os.path.join(path, COMMITS))
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _folder(path: str, commit: str) -> str:
    return os.path.join(path, commit.partition(".")[2])


def current_version(spark: SparkSession, path: str) -> str:
    """The folder that holds the table now; ``path`` itself where it is a plain folder of files."""
    found = commits(spark, path)
    return _folder(path, found[-1]) if found else path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as of now: later replacements do not change this frame."""
    return spark.read.parquet(current_version(spark, path))


def commit_version(spark: SparkSession, path: str, version: str) -> None:
    """Make the written folder ``path/version`` the table."""
    found = commits(spark, path)
    number = int(found[-1].partition(".")[0]) + 1 if found else 1
    fs, where = _fs(spark, os.path.join(path, COMMITS, f"{number:012d}.{version}"))
    fs.create(where, False).close()


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                  metrics: Mapping[str, Column] | None = None) -> Written:
    """Write ``df`` as the new version of the table at ``path``, observing ``metrics`` (aggregates) on the way."""
    version = f"v-{uuid.uuid4().hex}"
    written = write_observed(df, os.path.join(path, version), partition_by, metrics)
    commit_version(df.sparkSession, path, version)
    return written


def write_observed(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                   metrics: Mapping[str, Column] | None = None, mode: str = "errorifexists") -> Written:
    """Write ``df`` as Parquet; its ``metrics`` are by-products of the write, not a second scan."""
    seen = None
    if metrics:
        seen = Observation()
        df = df.observe(seen, *[c.alias(n) for n, c in metrics.items()])
    w = df.write.mode(mode)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return Written(path, dict(seen.get) if seen else {})


def swap_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
               metrics: Mapping[str, Column] | None = None) -> Written:
    """Write ``df`` beside the plain folder ``path``, and then put it in its place.

    For tables that others read by their path. A job that fails leaves the old table, and
    ``df`` may read it; only the two renames at the end are not one operation (what was there
    is then in ``path`` with the suffix ``.old-<id>``). Queries still reading the old files fail,
    as with any overwrite: ``replace_table`` spares them that.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    path = path.rstrip("/")
    fs, where = _fs(spark, path)
    new, old = (_fs(spark, f"{path}.{kind}-{mark}")[1] for kind in ("new", "old"))
    try:
        written = write_observed(df, new.toString(), partition_by, metrics)
    except BaseException:
        fs.delete(new, True)
        raise
    if fs.exists(where) and not fs.rename(where, old):
        raise OSError(f"{path} could not be moved aside")
    if not fs.rename(new, where):
        raise OSError(f"{new.toString()} could not be moved to {path}")
    fs.delete(old, True)
    return Written(path, written.metrics)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` versions, and folders that were never committed; returns the deleted ones.

    Call it when no query reads an older version and no replacement is under way.
    """
    found = commits(spark, path)
    stay = {c.partition(".")[2] for c in found[max(0, len(found) - max(1, keep)):]}
    fs, where = _fs(spark, path)
    gone = sorted(s.getPath().getName() for s in fs.listStatus(where)
                  if s.getPath().getName().startswith("v-") and s.getPath().getName() not in stay)
    for c in found:
        if c.partition(".")[2] not in stay:
            fs.delete(_fs(spark, os.path.join(path, COMMITS, c))[1], False)
    for g in gone:
        fs.delete(_fs(spark, os.path.join(path, g))[1], True)
    return gone



def row_count() -> dict[str, Column]:
    """The metric most writes want."""
    return {"rows": F.count(F.lit(1))}
