"""In-place rewrite of some partitions of a stored table (PRJ-9).

An UPDATE on a table of Parquet files replaces only the partitions that hold a matching
row; the files of all others stay as they are, byte for byte.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sunlight.operators.joins import materialise


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt anew for a write in partitions of ``columns``.

    Such a write sorts each task's rows by them, beside whatever the task holds already (the
    sorted sides of a join). Here it is a stage of its own, whose tasks AQE cuts to the advisory
    size, also within one value; and a value's rows lie in few files, not in one per task.
    """
    return df.hint("rebalance", *columns)


def rewrite_partitions(spark: SparkSession, path: str, partition_col: str, changes: Mapping[str, Column],
                       where: Column) -> list:
    """Set the columns ``changes`` of the rows that match ``where`` in the table at ``path``,
    stored by ``partition_col``; returns the values of the partitions that were rewritten.

    One scan of the columns of ``where`` finds the partitions (their values, metadata-sized, reach the
    driver). These alone are read, written aside to the shared folder, and then take the
    place of the old ones by a dynamic partition overwrite, so that a job that fails before
    leaves the table as it was. The partition column itself cannot be changed.
    """
    if partition_col in changes:
        raise ValueError(f"{partition_col} says where a row is stored and cannot be rewritten")
    table = spark.read.parquet(path)
    hit = F.coalesce(where, F.lit(False))
    found = [r[0] for r in table.where(hit).select(partition_col).distinct().collect()]
    if not found:
        return []
    key = F.col(partition_col)
    some = key.isin([v for v in found if v is not None])
    touched = table.where(some | key.isNull() if None in found else some)
    new: DataFrame = touched.select(*[
        F.when(hit, changes[c]).otherwise(F.col(c)).cast(table.schema[c].dataType).alias(c) if c in changes else F.col(c)
        for c in table.columns])
    aside = materialise(new, "rewrite")
    (by_partition(aside, partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(path))
    return found
