"""Stored tables that keep an order (TOP-4).

Rows are sorted in ranges, one folder per range (``__range=0``, ``1``, ...), and each
row holds its place in its range. Beside the data lies one small table of the ranges' offsets.
The first k rows are then read from the first folders alone, and a filter on
the leading sort column skips files and row groups by their statistics.
"""

from __future__ import annotations

import os
import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sunlight.operators.numbering import offsets, placed
from sunlight.sinks.versioned import Written, commit_version, current_version, row_count, write_observed

RANGE, PLACE = "__range", "__place"


def write_ordered(df: DataFrame, path: str, order: Sequence[Column], partitions: int | None = None) -> Written:
    """Create or replace the table at ``path``, stored by ``order`` (a total order)."""
    spark, version = df.sparkSession, f"v-{uuid.uuid4().hex}"
    base = os.path.join(path, version)
    data = write_observed(placed(df, order, RANGE, PLACE, partitions), os.path.join(base, "rows"), [RANGE], row_count())
    if data.metrics["rows"]:
        before = offsets(spark.read.parquet(data.path).select(RANGE), RANGE)
    else:                                    # no folder of a range was made: one file holds the columns
        before = []
        placed(df, order, RANGE, PLACE, 1).limit(0).coalesce(1).write.mode("overwrite").parquet(data.path)
    spark.createDataFrame(before, f"{RANGE} int, __before long").write.parquet(os.path.join(base, "offsets"))
    commit_version(spark, path, version)
    return Written(base, data.metrics)


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    base = current_version(spark, path)
    rows = spark.read.option("basePath", os.path.join(base, "rows")).parquet(os.path.join(base, "rows"))
    return rows, spark.read.parquet(os.path.join(base, "offsets"))


def ordered_table(spark: SparkSession, path: str, name: str = "rang") -> DataFrame:
    """All rows, with their place (from 1) in the stored order."""
    rows, before = _parts(spark, path)
    return (rows.join(F.broadcast(before), RANGE).withColumn(name, F.col("__before") + F.col(PLACE) + 1)
            .drop(RANGE, PLACE, "__before"))


def first_rows(spark: SparkSession, path: str, k: int, name: str = "rang") -> DataFrame:
    """The first ``k`` rows in order: only the ranges that hold them are listed and read."""
    rows, before = _parts(spark, path)
    starts = {r[RANGE]: r["__before"] for r in before.where(F.col("__before") < k).collect()}   # one row per range read
    before = spark.createDataFrame(list(starts.items()), f"{RANGE} int, __before long")
    return (rows.where(F.col(RANGE).isin(list(starts))).join(F.broadcast(before), RANGE)
            .withColumn(name, F.col("__before") + F.col(PLACE) + 1).where(F.col(name) <= k)
            .drop(RANGE, PLACE, "__before").orderBy(name))
