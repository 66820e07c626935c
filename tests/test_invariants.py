"""Invariants on the star tables: partition independence, conservation,
uniqueness of mart keys."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
import __spark_entry__ as E
from suite.queries import Inputs

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["labo", "region", "total_cadeaux", "ventes_princeps", "total_ventes",
                          "pct_princeps", "roi_influence"]


@pytest.mark.parametrize("name", ["fact_influence", "recipients", "top3_products", "geo_ref_first",
                                  "search_batch", "dedup_sum"])
def test_partition_independence(spark, name):
    q = E.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = rows(q(spark, SF))
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = rows(q(spark, SF))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b


def test_mart_keys_unique(spark):
    i = Inputs(spark, SF)
    for df, keys in [(i.sales, ["code_region", "cip13", "est_generique", "labo_ansm"]),
                     (i.fact(), ["labo", "region"]), (i.geo, ["cp"]),
                     (i.name_map, ["name_transparence", "name_ansm"])]:
        assert df.groupBy(*keys).count().where(F.col("count") > 1).count() == 0


def test_spend_conserves_mapped_amounts(spark):
    """Spend equals the staged amounts of influence motives, counted once per
    catalogue name the payer maps to (here exactly one) and per department."""
    i = Inputs(spark, SF)
    from sunlight.plans.influence import INFLUENCE_MOTIVES
    stg = i.stg.where(F.col("motif").isin(list(INFLUENCE_MOTIVES)))
    mapped = stg.join(i.name_map, stg.labo == i.name_map.name_transparence)
    with_region = i.decl_geo.where(F.col("region_code").isNotNull()).select("labo", "nom", "date", "montant", "motif")
    expected = (with_region.where(F.col("motif").isin(list(INFLUENCE_MOTIVES)))
                .agg(F.sum("montant")).first()[0])
    assert mapped.count() == stg.count()
    got = i.spend.agg(F.sum("total_cadeaux")).first()[0]
    assert got == expected


def test_fact_formula(spark):
    fact = Inputs(spark, SF).fact().collect()
    for r in fact:
        if r["total_cadeaux"]:
            assert r["roi_influence"] == pytest.approx(round(r["ventes_princeps"] / float(r["total_cadeaux"])), abs=1)
        if r["total_ventes"]:
            assert r["pct_princeps"] == pytest.approx(100 * r["ventes_princeps"] / r["total_ventes"], abs=0.051)
