"""What must not grow with the tables: scans of the declarations, rows moved twice, the share of one task."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from suite import queries as Q
from suite import star
from sunlight import plans as P
from sunlight.operators import aggregates as A
from sunlight.operators import dedup_sum
from sunlight.sinks import buckets_for, by_partition, rewrite_partitions
from sunlight.sinks import bucketed as B

SF = "/root/testdata/sf0.001"


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet")


@pytest.mark.parametrize("name", ["fact_influence", "group_preview", "recipients", "search", "search_limit", "search_report",
                                  "search_mart", "search_batch", "search_index"])
def test_declarations_are_joined_once(spark, name):
    """Beside the one join that is written, the plan scans the lines for the prescriptions only."""
    assert scans(Q.QUERIES[name](spark, SF)) <= 1


@pytest.mark.parametrize("build", [star.declarations_raw, star.prescriptions_raw])
def test_lines_meet_orders_that_know_their_customers(spark, build):
    """Orders find their customers below the lines: these are not shuffled by customer, whatever the sizes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build(spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    join = lambda key: next(line for line in plan if "Join" in line and key in line)
    assert depth(join("o_custkey")) > depth(join("l_orderkey"))


def test_one_shuffle_sums_as_two(spark, monkeypatch):
    data = [("hot", None, str(k % 50)) for k in range(400)] + [(f"g{k % 30}", "x", str(k % 7)) for k in range(200)] + [
        (None, "y", "1"), (None, "y", "1"), ("g1", "x", None)]
    df = spark.createDataFrame(data, "g string, h string, v string").repartition(5)
    amount = F.col("v").cast("decimal(18,2)")
    plain = dedup_sum(df, ["g", "h", "v"], ["g", "h"], amount, "s")
    once = dedup_sum(df, ["g", "h", "v"], ["g", "h"], amount, "s", one_shuffle=True)
    assert once._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(once) == rows(plain)
    monkeypatch.setattr(A, "HOT_ROWS", 300)
    split = dedup_sum(df, ["g", "h", "v"], ["g", "h"], amount, "s", one_shuffle=True)
    assert "Union" in split._jdf.queryExecution().optimizedPlan().toString()
    assert rows(split) == rows(plain)


def test_spend_from_the_geo_mart_joins_no_departments(spark, fx):
    stg = P.stg_declarations(fx["raw"])
    bridge = P.product_bridge(fx["packs"], fx["products"])
    name_map = P.lab_name_map(stg, bridge)
    geo = P.declarations_geo(stg, fx["raw"], fx["depts"])
    joined = P.influence_spend(stg, name_map, fx["raw"], fx["depts"])
    located = P.influence_spend(stg, name_map, fx["raw"], fx["depts"], located=geo)
    assert rows(located) == rows(joined) and located.count() > 0


def test_a_partitioned_write_is_a_stage_of_its_own(spark, tmp_path):
    """Rows of many tasks, of few values: few files, and each task's rows bounded by the advisory size."""
    path = str(tmp_path / "t")
    df = spark.range(4000).select("id", (F.col("id") % 2).cast("int").alias("p"), F.lit("a").alias("v")).repartition(16)
    by_partition(df, "p").write.partitionBy("p").parquet(path)
    files = lambda v: [f for f in os.listdir(f"{path}/p={v}") if f.endswith(".parquet")]
    assert len(files(0)) + len(files(1)) <= 4
    rewrite_partitions(spark, path, "p", {"v": F.lit("b")}, (F.col("p") == 1) & (F.col("id") > 10))
    assert rows(spark.read.parquet(path).groupBy("p", "v").count()) == [(0, "a", 2000), (1, "a", 5), (1, "b", 1995)]


def test_buckets_grow_with_the_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "in put")
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))
    assert buckets_for(df) == 8
    monkeypatch.setattr(B, "BUCKET_BYTES", size // 20)
    assert 20 <= buckets_for(df, df.where("id > 5")) <= 21
