"""Aggregate-shaped operators that Spark has no single verb for."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F


def ranked_string_agg(df: DataFrame, group_cols: Sequence[str], rank_col: str,
                      value_col: str, sep: str, out: str) -> DataFrame:
    """``string_agg(value, sep ORDER BY rank)`` per group.

    Meant to run after a per-group top-k: each group then carries at most k
    values, so the list built per group is bounded by k.
    """
    pairs = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"),
                                                 F.col(value_col).alias("v"))))
    return (df.groupBy(*group_cols)
            .agg(F.array_join(F.transform(pairs, lambda x: x["v"]), sep).alias(out)))


def group_max_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     value_col: str, out: str) -> DataFrame:
    """Correlated scalar subquery ``(SELECT MAX(v) FROM right r WHERE r.k = l.k)``.

    Decorrelated into a partial/final aggregate of ``right`` per key and a
    left join, so a key with no match (or a NULL key) yields NULL. The
    aggregate is combined map-side, so a hot key costs one row per task.
    """
    agg = right.groupBy(*keys).agg(F.max(value_col).alias(out))
    return left.join(agg, on=list(keys), how="left")


def first_by_order(df: DataFrame, key_cols: Sequence[str], order_cols: Sequence[str],
                   keep: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the one with the smallest ``order_cols`` tuple.

    Expressed as ``min(struct(order..., keep...))`` - a hash aggregate with
    map-side combine, so no sort and no oversized task for a hot key.
    Ties on ``order_cols`` are broken by the ``keep`` columns.
    """
    keep = [c for c in (keep or []) if c not in order_cols]
    fields = [F.col(c) for c in list(order_cols) + keep]
    best = F.min(F.struct(*fields)).alias("_best")
    return (df.groupBy(*key_cols).agg(best)
            .select(*key_cols, *[F.col(f"_best.{c}").alias(c) for c in list(order_cols) + keep]))


GROUP_BUCKETS = 1 << 12
HOT_ROWS, HOT_SHARE = 1_000_000, 16      # a bucket is hot beyond both: rows, times the mean


def _hot_buckets(df: DataFrame, bucket) -> list[int]:
    """The hash buckets of groups that hold too many rows for one task (a count per bucket reaches the driver)."""
    counts = {r["bucket"]: r["count"] for r in df.groupBy(bucket.alias("bucket")).count().collect()}
    limit = max(HOT_ROWS, HOT_SHARE * sum(counts.values()) / GROUP_BUCKETS)
    return sorted(b for b, n in counts.items() if n > limit)


def dedup_sum(df: DataFrame, dedup_cols: Sequence[str], group_cols: Sequence[str],
              amount, out: str, one_shuffle: bool = False) -> DataFrame:
    """Drop exact duplicates on ``dedup_cols``, then sum ``amount`` per group.

    ``amount`` is a column name or an expression over the de-duplicated
    columns (e.g. a parser applied to the raw text). Two aggregates, both
    with map-side combine: a group holding a third of all rows is spread by
    its other columns during the de-duplication and reaches the final sum as
    one partial row per task.

    With ``one_shuffle`` rows are dealt by group at once, where both aggregates
    find them: less is moved where most groups have few rows, at the price of one more scan
    that counts rows per hash of the group. Groups in hot buckets keep the two steps.
    """
    amount_col = F.col(amount) if isinstance(amount, str) else amount

    def summed(rows: DataFrame) -> DataFrame:
        return rows.distinct().groupBy(*group_cols).agg(F.sum(amount_col).alias(out))

    rows = df.select(*dedup_cols)
    if not one_shuffle:
        return summed(rows)
    bucket = F.pmod(F.xxhash64(*group_cols), F.lit(GROUP_BUCKETS))
    hot = _hot_buckets(rows, bucket)
    if not hot:
        return summed(rows.repartition(*group_cols))
    return summed(rows.where(~bucket.isin(hot)).repartition(*group_cols)).unionAll(summed(rows.where(bucket.isin(hot))))
