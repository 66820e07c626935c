"""Global order without a single task."""

from __future__ import annotations

from itertools import accumulate
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sunlight.operators.joins import materialise

_IN_PARTITION = (1 << 33) - 1             # the lower bits of monotonically_increasing_id


def placed(df: DataFrame, order: Sequence[Column], part: str, place: str, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with each row's partition and its place in it (from 0)."""
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return (dealt.sortWithinPartitions(*order)
            .withColumns({part: F.spark_partition_id(),
                          place: F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))}))


def offsets(written: DataFrame, part: str) -> list[tuple[int, int]]:
    """(partition, rows before it) of a written ``placed`` frame; one row per partition."""
    counts = sorted((r[part], r["count"]) for r in written.groupBy(part).count().collect())
    return [(p, before) for (p, _), before in zip(counts, accumulate((n for _, n in counts), initial=0))]


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "rang", partitions: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 1) in the global ``order``, whatever its size.

    A ``row_number`` over an unpartitioned window would sort everything in one
    task. Here rows are sorted in ranges, written with their place in their range, and the
    ranges' row counts (one per partition) give the offsets. ``order`` must be
    a total order for the numbers to be deterministic.
    """
    written = materialise(placed(df, order, "__part", "__place", partitions), "numbered")
    before = df.sparkSession.createDataFrame(offsets(written, "__part"), "__part int, __before long")
    return (written.join(F.broadcast(before), "__part")
            .withColumn(name, F.col("__before") + F.col("__place") + 1).drop("__part", "__place", "__before"))
