"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sunlight.session import scratch_path

# Largest id: a row without doc_id is ordered after every other document.
NO_ID = (1 << 63) - 1


def stash(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    This is how lineage is cut: the table survives lost executors, later
    passes reread it instead of recomputing it, and row ids drawn before the
    write stay fixed.
    """
    path = scratch_path(spark, f"llm-{name}")
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def doc_key(col: str = "doc_id") -> Column:
    """``col`` as long with null ordered after every other id."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def from_key(col: str = "doc_id") -> Column:
    """Inverse of :func:`doc_key`."""
    return F.when(F.col(col) != F.lit(NO_ID), F.col(col))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def restored(kind: type, state: dict):
    """An object of ``kind`` with these attributes: models are broadcast as plain state."""
    made = kind.__new__(kind)
    vars(made).update(state)
    return made
