"""The stored search index gives the rows of the scanning search, and reads the term's partitions only."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sunlight import plans as P
from sunlight.session import scratch_path
from sunlight.sinks import current_version

def files_read(df):
    """Files that the scan of a plan without exchanges reads."""
    plan = df._jdf.queryExecution()
    plan.toRdd().count()
    leaves = plan.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


TERMS = ["mar", "du", "x", "PARI", "ma%in", "pa_is", "100%", "a\\b", "zzz", "İz", "émi", "%%%%"]


@pytest.fixture(scope="module")
def marts(spark):
    names = ["MARTIN", "MARTIN DUPONT", "Martine", "DUPONT", "DU", "X", "", None, "O'BRIEN", "A\\B", "100% BIO", "ÉMILE", "émilie", "İzmir",
             "MAR_IN", "D UPONT"]
    cities = ["PARIS", "PARIS 12", "Lyon", "", None, "PARAY", "martinique", "LYO", "duxx"]
    people = [(n, f"p{i}", c, None if i % 4 else "s", f"SAS {i % 3}", f"LAB {i % 3}" if i % 5 else None, "11" if i % 2 else None, float(100 + i))
              for i, (n, c) in enumerate((n, c) for n in names for c in cities)]
    recipients = spark.createDataFrame(people, "nom string, prenom string, ville string, specialite string, labo_source string, "
                                               "labo_normalise string, region_code string, montant_total double")
    regions = spark.createDataFrame([("11", "Île-de-France")], "code string, libelle_reg string")
    fact = spark.createDataFrame([("LAB 1", "Île-de-France", 3.0, 40.0)], "labo string, region string, roi_influence double, pct_princeps double")
    best = spark.createDataFrame([("LAB 1", "A | B")], "labo_ansm string, top_produits string")
    path = scratch_path(spark, "index")
    figures = P.build_search_index(recipients, path, parts=8, buckets=32)
    return recipients, regions, fact, best, path, figures


@pytest.mark.parametrize("literal", [False, True])
def test_index_equals_the_scan(spark, marts, literal):
    recipients, regions, fact, best, path, figures = marts
    assert figures["rows"] == recipients.count()
    for q in TERMS if not literal else ("pa_is", "100%"):
        want = P.search_recipients(recipients, regions, fact, best, q, k=400, literal=literal)
        got = P.search_index(spark, path, q, regions, fact, best, k=400, literal=literal)
        assert rows(got) == rows(want), q


def test_a_term_reads_its_partitions_only(spark, marts):
    path = marts[4]
    found = P.look_up(spark, path, "MARTINE")
    plan = found.keys._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket", plan)
    every = spark.read.parquet(current_version(spark, path) + "/keys")
    assert files_read(found.keys) <= 2 < 20 < files_read(every)     # of its rarest gram, and of its start as a city
    assert len(found.parts) == 1 and files_read(found.rows) == 1
    assert P.look_up(spark, path, "zzz").parts == []
    assert P.look_up(spark, path, "q").parts == []


def test_index_is_replaced_at_once(spark, marts):
    recipients, regions, fact, best, _, _ = marts
    path = scratch_path(spark, "index")
    P.build_search_index(recipients, path, parts=4, buckets=8)
    P.build_search_index(recipients.where("nom <> 'DU'"), path, parts=16, buckets=64)
    got = P.search_index(spark, path, "du", regions, fact, best, k=400)
    assert "DU" not in {r["nom"] for r in got.collect()}
    P.build_search_index(recipients.where("false"), path)
    assert P.search_index(spark, path, "du", regions, fact, best).count() == 0


@pytest.mark.parametrize("min_len", [1, 2])
def test_batch_equals_single_searches(spark, marts, min_len):
    recipients, regions, fact, best, _, _ = marts
    terms = ["mar", "du", "x", "PARI", "100%", "a\\b", "zzz", "émi"]
    batch = P.search_recipients_batch(recipients, regions, fact, best, spark.createDataFrame([(t,) for t in terms + terms[:3]], "term string"),
                                      k=30, min_len=min_len).drop("rank")
    want = []
    for q in terms:
        one = P.search_recipients(recipients, regions, fact, best, q, k=30, literal=True, min_len=min_len)
        want += [(q, *t) for t in rows(one)]
    columns = [c for c in batch.columns if c != "term"]
    assert sorted(map(str, rows(batch, "term", *one.columns))) == sorted(map(str, want))
    assert set(columns) == set(one.columns)
