"""Derived join sides as written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from sunlight.session import scratch_path


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet (by default into the shared folder) and read it back.

    A derived side (an aggregate, a join of two catalogues) has no size the
    planner could trust; a written one has. The planner then broadcasts it
    below ``spark.sql.autoBroadcastJoinThreshold`` and plans a shuffle join
    beyond, with no hint, no cached blocks and no extra counting job.
    """
    path = path or scratch_path(df.sparkSession, name)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
