"""Connected components of a link table, on executors.

Alternating large-star and small-star rounds: every round hangs each node's
larger (then smaller) neighbours on the smallest node it knows, so paths
shrink geometrically and the table ends as stars around the smallest node.
A round is an aggregate with map-side combine and a join back; each result
is written to the shared folder, which cuts lineage and survives lost
executors. Links are never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import stash


def _hang(both: DataFrame) -> DataFrame:
    """(u, v, low): each directed link with the least of u and its neighbours."""
    low = both.groupBy("u").agg(F.min("v").alias("least"))
    return both.join(low, "u").select("u", "v", F.least("u", "least").alias("low"))


def connected_components(spark: SparkSession, links: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node reachable.

    ``links`` holds pairs of comparable values in columns ``a`` and ``b``;
    direction, repeats and self links do not matter.
    """
    x, y = F.col(a), F.col(b)
    stars = stash(spark, links.where(x != y)
                  .select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "cc-links")
    for _ in range(max_rounds):
        both = stars.unionAll(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")) \
            .where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
                              F.struct(F.col("u").alias("u"), F.col("low").alias("v")))).alias("e")) \
            .select("e.u", "e.v").where("u <> v").distinct()
        nxt = stash(spark, small, "cc-round")
        # A forest of stars: nobody hangs on two nodes, and no centre hangs on another node.
        seen = nxt.select(F.explode(F.array(
            F.struct(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
            F.struct(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("e")) \
            .groupBy("e.x").agg(F.sum("e.up").alias("up"), F.max("e.down").alias("down"))
        odd = seen.agg(F.max((F.col("up") + F.col("down") > 1).cast("int"))).first()[0]
        stars = nxt
        if not odd:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
