"""Top-k operators.

``top_k`` plans as ``TakeOrderedAndProject``: every task keeps its own k
best rows and only k x tasks rows reach the final merge, whatever the
input size. ``top_k_per_group`` plans a ``WindowGroupLimit`` on both sides
of the shuffle, so even a group holding a third of all rows is cut to k
rows per map task before it is exchanged.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global ORDER BY ... LIMIT k. ``order`` must be a total order (add
    tie-breaks) for the result to be deterministic."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                    k: int, rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k within each group by ``row_number`` over ``order``."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .where(F.col(rank_col) <= k))


def ranked_top_k(df: DataFrame, order: Sequence[Column], k: int, rank_col: str = "rang") -> DataFrame:
    """``top_k`` with its place (1..k) as a column, so the order survives storage.

    Only the k best rows reach the numbering window.
    """
    return (top_k(df, order, k).withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
            .orderBy(rank_col))
