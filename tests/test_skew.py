"""A hot key (about half of all payments on one recipient and one date) must
give the same results whether or not AQE splits the skewed join partitions."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from suite.queries import Inputs
from sunlight import plans as P

SF = "/root/testdata/sf0.001"

FORCE_SKEW = {
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # keep the (name, date) join a sort-merge join so the split path runs
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
NO_SKEW = {"spark.sql.adaptive.skewJoin.enabled": "false"}


def hot_inputs(spark):
    i = Inputs(spark, SF)
    transport = F.col("motif_lien_interet") == "Frais de transport"
    raw = (i.raw.withColumn("identite", F.when(transport, F.lit("HOT")).otherwise(F.col("identite")))
           .withColumn("date", F.when(transport, F.lit("2000-01-01")).otherwise(F.col("date"))))
    return i, raw


def results(spark):
    i, raw = hot_inputs(spark)
    stg = P.stg_declarations(raw)
    geo = P.declarations_geo(stg, raw, i.depts)
    name_map = P.lab_name_map(stg, i.bridge)
    spend = P.influence_spend(stg, name_map, raw, i.depts)
    rec = P.recipients(raw, name_map, geo, min_total=100_000)
    geo_sum = geo.agg(F.count(F.lit(1)), F.sum("montant")).first()
    terms = spark.createDataFrame([("hot",), ("customer#0000001",)], "term string")
    fact = P.influence_fact(spend, i.sales, i.regions)
    batch = P.search_recipients_batch(rec, i.regions, fact, P.lab_top_products(i.bridge), terms)
    return tuple(geo_sum), rows(spend), rows(rec), rows(batch)


@pytest.fixture()
def conf(spark):
    saved = {}

    def apply(settings):
        for k, v in settings.items():
            saved.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)
    yield apply
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_is_really_hot(spark):
    _, raw = hot_inputs(spark)
    share = raw.where(F.col("identite") == "HOT").count() / raw.count()
    assert share > 0.33


def test_forced_settings_split_the_hot_partition(spark, conf):
    conf(FORCE_SKEW)
    i, raw = hot_inputs(spark)
    stg = P.stg_declarations(raw)
    geo = P.declarations_geo(stg, raw, i.depts)
    geo.collect()
    final = geo._jdf.queryExecution().executedPlan().toString()
    assert "isSkewJoin=true" in final or "skewed" in final.lower()


def test_skew_split_does_not_change_results(spark, conf):
    conf(NO_SKEW)
    plain = results(spark)
    conf(FORCE_SKEW)
    split = results(spark)
    assert plain == split
    assert any(r[0] == "HOT" for r in plain[2])            # the hot recipient is there, whole
