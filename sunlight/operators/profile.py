"""Schema introspection (PRJ-6..8)."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def schema_profile(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(position, name, type) per column - metadata only, no data scan."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, name string, type string")


def search_columns(profile: DataFrame, substrings: Iterable[str]) -> DataFrame:
    """PRJ-7: the rows of a schema profile whose column name holds any of ``substrings``."""
    subs = list(substrings)
    if not subs:
        return profile.where(F.lit(False))
    return profile.where(reduce(lambda a, b: a | b, [F.contains("name", F.lit(s)) for s in subs]))


def find_columns(df: DataFrame, substrings: Iterable[str]) -> list[str]:
    """Column names containing any of ``substrings`` (e.g. dep/reg/dpt)."""
    subs = list(substrings)
    return [c for c in df.columns if any(s in c for s in subs)]


def first_rows_by_position(df: DataFrame, n: int, order: Sequence[Column] | None = None) -> DataFrame:
    """The first ``n`` rows as (row, position, value) text triples.

    Without ``order`` any ``n`` rows, numbered as they come. Only these rows
    reach the numbering window.
    """
    head = df.orderBy(*order).limit(n) if order else df.limit(n)
    values = F.array(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    by = order if order else [F.monotonically_increasing_id()]
    ranked = head.withColumn("_vals", values).withColumn("row", F.row_number().over(Window.orderBy(*by)) - 1)
    return ranked.select("row", F.posexplode("_vals").alias("position", "value"))
