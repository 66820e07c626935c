"""Join fan-out report: how much a join multiplies rows and money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sunlight.functions import safe_div


def join_fanout(left: DataFrame, right: DataFrame, on: "Column | list[str] | str",
                amount_col: str, how: str = "inner") -> DataFrame:
    """One row: rows and amount of ``left`` before the join, and after it.

    Both sides are reduced to single-row aggregates on the executors and
    combined with a key-less union, so the report costs two aggregations,
    never a collect of the data. ``fanout`` > 1 means some left rows were
    counted more than once (a many-to-many map, several departments...);
    without left rows it is NULL.
    """
    before = left.agg(F.count(F.lit(1)).alias("n"), F.sum(amount_col).alias("s"))
    after = left.join(right, on, how).agg(F.count(F.lit(1)).alias("n"),
                                          F.sum(left[amount_col]).alias("s"))
    tagged = (before.select(F.lit(0).alias("k"), "n", "s")
              .unionByName(after.select(F.lit(1).alias("k"), "n", "s")))
    return tagged.agg(
        F.max(F.when(F.col("k") == 0, F.col("n"))).alias("rows_before"),
        F.max(F.when(F.col("k") == 1, F.col("n"))).alias("rows_after"),
        F.max(F.when(F.col("k") == 0, F.col("s"))).alias("amount_before"),
        F.max(F.when(F.col("k") == 1, F.col("s"))).alias("amount_after"),
    ).withColumn("fanout", safe_div("rows_after", "rows_before"))
