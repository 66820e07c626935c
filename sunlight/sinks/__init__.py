"""Writers (SNK-1..4). Outputs are Parquet directories; the partition
count is left to Spark (no ``coalesce(1)``: a single writer task would
serialise the whole table through one executor)."""

from __future__ import annotations

import os
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sunlight.sinks.bucketed import buckets_for, write_bucketed
from sunlight.sinks.rewrite import by_partition, rewrite_partitions
from sunlight.sinks.sorted import first_rows, ordered_table, write_ordered
from sunlight.sinks.versioned import (Written, commits, current_version, drop_old_versions, read_table, replace_table,
                                      row_count, swap_table, write_observed)

__all__ = ["write_table", "export_marts", "export_observed", "json_records", "write_json", "Written", "commits",
           "current_version", "drop_old_versions", "read_table", "replace_table", "row_count", "swap_table", "write_observed",
           "first_rows", "ordered_table", "write_ordered", "rewrite_partitions", "by_partition", "write_bucketed",
           "buckets_for"]


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] | None = None) -> str:
    """SNK-1/2: create-or-replace a table as Parquet at ``path``.

    ``overwrite`` writes beside the table and then swaps (``swap_table``): a failed job leaves
    the old one, and a table can be replaced from itself. ``replace_table`` keeps versions.
    """
    if mode == "overwrite":
        return swap_table(df, path, partition_by).path
    return write_observed(df, path, partition_by, mode=mode).path


def export_observed(marts: Mapping[str, DataFrame], out_dir: str,
                    metrics: Mapping[str, Mapping[str, Column]] | None = None) -> dict[str, Written]:
    """SNK-3: replace each named mart at ``out_dir/<name>.parquet``; rows (and further ``metrics`` by mart)
    are counted while writing."""
    return {name: swap_table(df, os.path.join(out_dir, f"{name}.parquet"),
                             metrics={**row_count(), **(metrics or {}).get(name, {})})
            for name, df in marts.items()}


def export_marts(marts: Mapping[str, DataFrame], out_dir: str) -> dict[str, str]:
    """SNK-3: the folders written by ``export_observed``."""
    return {name: w.path for name, w in export_observed(marts, out_dir).items()}


def json_records(df: DataFrame) -> DataFrame:
    """SNK-4: one JSON object per row (column ``json``), computed on executors."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("json"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path
