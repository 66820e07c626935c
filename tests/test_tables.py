"""Stored tables: all-or-nothing replacement, observed figures, stored order, in-place rewrite."""

import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sunlight.operators import in_key_set, key_set, number_rows
from sunlight.session import scratch_path
from sunlight.sinks import (commits, current_version, drop_old_versions, export_observed, first_rows, ordered_table, read_table,
                            replace_table, rewrite_partitions, row_count, swap_table, write_ordered, write_table)


def failing(df):
    """A frame of which a task fails."""
    return df.withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("stop"))).otherwise(F.col("id")))


def test_a_failed_replacement_leaves_the_table(spark):
    path = scratch_path(spark, "t")
    replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="stop"):
        replace_table(failing(spark.range(100)), path)
    assert read_table(spark, path).count() == 5
    assert len(commits(spark, path)) == 1
    replace_table(spark.range(6), path)
    assert read_table(spark, path).count() == 6


def test_a_failed_overwrite_leaves_the_plain_table(spark):
    path = scratch_path(spark, "t")
    write_table(spark.range(5), path)
    with pytest.raises(Exception, match="stop"):
        write_table(failing(spark.range(100)), path)
    assert spark.read.parquet(path).count() == 5
    assert os.listdir(os.path.dirname(path)).count(os.path.basename(path)) == 1
    assert not glob.glob(path + ".*")
    write_table(spark.read.parquet(path).where("id > 1"), path)              # from itself
    assert rows(spark.read.parquet(path)) == [(2,), (3,), (4,)]
    write_table(spark.range(1), path, mode="append")
    assert spark.read.parquet(path).count() == 4


def test_readers_keep_the_version_they_began_with(spark):
    path = scratch_path(spark, "t")
    replace_table(spark.range(3), path)
    old = read_table(spark, path)
    replace_table(old.select((F.col("id") + 10).alias("id")), path)
    assert rows(old) == [(0,), (1,), (2,)]
    assert rows(read_table(spark, path)) == [(10,), (11,), (12,)]
    replace_table(spark.range(1), path, partition_by=None)
    gone = drop_old_versions(spark, path, keep=1)
    assert len(gone) == 2 and len(commits(spark, path)) == 1
    assert rows(read_table(spark, path)) == [(0,)]


def test_versions_that_were_never_committed_are_no_table(spark):
    path = scratch_path(spark, "t")
    replace_table(spark.range(2), path)
    now = current_version(spark, path)
    spark.range(9).write.parquet(os.path.join(path, "v-lost"))
    assert current_version(spark, path) == now
    assert drop_old_versions(spark, path, keep=5) == ["v-lost"]


def test_figures_are_observed_while_writing(spark):
    df = spark.range(0, 1000, numPartitions=7).withColumn("v", F.col("id") % 10)
    seen = swap_table(df, scratch_path(spark, "t"), metrics={**row_count(), "total": F.sum("v"), "odd": F.count_if(F.col("v") % 2 == 1)})
    assert seen.metrics == {"rows": 1000, "total": 4500, "odd": 500}
    out = export_observed({"a": df, "b": df.limit(0)}, scratch_path(spark, "x"), {"a": {"most": F.max("id")}})
    assert out["a"].metrics == {"rows": 1000, "most": 999} and out["b"].metrics == {"rows": 0}
    assert spark.read.parquet(out["a"].path).count() == 1000


def test_marts_come_with_their_figures(spark, fx):
    from sunlight import plans as P
    marts = P.build_marts(spark, scratch_path(spark, "m"), fx["raw"], fx["rx"], fx["products"], fx["packs"], fx["depts"],
                          fx["regions"], fx["specialities"])
    for name, path in marts.items():
        assert marts.metrics[name]["rows"] == spark.read.parquet(path).count()
    assert marts.metrics["stg_declarations"]["amount"] == spark.read.parquet(marts["stg_declarations"]).agg(
        F.sum("montant").cast("decimal(38,6)")).first()[0]


# -- stored order -----------------------------------------------------------

def unordered(spark, n=2000):
    return spark.range(0, n, numPartitions=5).select(
        F.pmod(F.xxhash64("id"), F.lit(300)).alias("k"), F.col("id"),
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("partitions", [None, 1, 9])
def test_number_rows_is_the_global_order(spark, partitions):
    df = unordered(spark)
    got = number_rows(df, [F.desc("k"), F.asc("id")], "place", partitions).collect()
    want = sorted(((r["k"], r["id"]) for r in df.collect()), key=lambda t: (-t[0], t[1]))
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got) == list(range(1, 2001))
    assert number_rows(df.where("false"), [F.asc("k")]).count() == 0


def test_ordered_table_reads_back_in_order(spark):
    df, path = unordered(spark), scratch_path(spark, "o")
    order = [F.asc_nulls_last("v"), F.desc("k"), F.asc("id")]
    assert write_ordered(df, path, order, partitions=12).metrics == {"rows": 2000}
    want = [(r["k"], r["id"], r["v"]) for r in df.orderBy(*order).collect()]
    back = ordered_table(spark, path, "place")
    assert back.columns == ["k", "id", "v", "place"]
    assert [tuple(r)[:3] for r in back.orderBy("place").collect()] == want
    first = first_rows(spark, path, 30, "place")
    assert [tuple(r)[:3] for r in first.collect()] == want[:30]
    assert first_rows(spark, path, 10 ** 6).count() == 2000
    # replaced by itself, in another order
    write_ordered(back.drop("place"), path, [F.asc("id")])
    assert [r["id"] for r in first_rows(spark, path, 5).collect()] == [0, 1, 2, 3, 4]
    write_ordered(df.where("false"), path, [F.asc("id")])
    assert ordered_table(spark, path).count() == 0 and first_rows(spark, path, 3).count() == 0


def test_the_first_rows_read_the_first_files_only(spark, capsys):
    path = scratch_path(spark, "o")
    write_ordered(unordered(spark), path, [F.asc("id")], partitions=16)
    first_rows(spark, path, 20).explain("formatted")
    listed = re.search(r"PartitionFilters: \[.*__range#\d+ (IN \(([^)]*)\)|= (\d+))", capsys.readouterr().out)
    assert (listed.group(2) or listed.group(3)) == "0"
    got = first_rows(spark, path, 20).select("id", "rang").collect()
    assert [tuple(r) for r in got] == [(i, i + 1) for i in range(20)]


# -- in-place rewrite -------------------------------------------------------

def files_of(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(path + "/*/*.parquet")}


def test_rewrite_touches_matching_partitions_only(spark):
    path = scratch_path(spark, "r")
    df = spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("p"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    df = df.withColumn("p", F.when(F.col("id") != 9, F.col("p")))              # one row in the partition of nulls
    df.write.partitionBy("p").parquet(path)
    before = files_of(path)
    done = rewrite_partitions(spark, path, "p", {"name": F.lit("new")}, F.col("name").isin("n7", "n12", "n9"))
    assert sorted(done, key=str) == [2, None]
    after = files_of(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {os.path.basename(os.path.dirname(f)) for f in same} == {"p=0", "p=1", "p=3", "p=4"}
    want = [(i, "new" if i in (7, 12, 9) else f"n{i}", None if i == 9 else i % 5) for i in range(100)]
    assert rows(spark.read.parquet(path), "id", "name", "p") == rows(spark.createDataFrame(want, "id long, name string, p int"))
    assert rewrite_partitions(spark, path, "p", {"name": F.lit("x")}, F.col("name") == "none") == []
    assert files_of(path) == after
    with pytest.raises(ValueError):
        rewrite_partitions(spark, path, "p", {"p": F.lit(1)}, F.lit(True))


# -- key sets ---------------------------------------------------------------

def test_key_set_has_no_false_negative(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("a"), (F.col("id") % 3).alias("b"))
    asked = spark.range(20000).select(F.concat(F.lit("k"), F.col("id")).alias("a"), (F.col("id") % 3).alias("b"))
    got = asked.withColumn("s", key_set(keys, "a", "b")).where(in_key_set(F.col("s"), F.col("a"), F.col("b"))).drop("s")
    n = got.count()
    assert got.join(keys, ["a", "b"], "left_semi").count() == 5000
    assert n < 5000 + 300                                                    # 5000 keys in a million bits
    none = asked.withColumn("s", key_set(keys.where("false"), "a", "b")).where(in_key_set(F.col("s"), F.col("a"), F.col("b")))
    assert none.count() == 0
