"""Recipient search (QRY-1/2) and landing stats (QRY-3)."""

import pytest
from pyspark.sql import functions as F

import fixture_c as C
from conftest import rows
from sunlight import plans as P


@pytest.fixture(scope="module")
def s(spark, fx):
    stg = P.stg_declarations(fx["raw"])
    geo = P.declarations_geo(stg, fx["raw"], fx["depts"])
    bridge = P.product_bridge(fx["packs"], fx["products"])
    name_map = P.lab_name_map(stg, bridge)
    sales = P.sales_mart(fx["rx"], bridge)
    fact = P.influence_fact(P.influence_spend(stg, name_map, fx["raw"], fx["depts"], C.MOTIVES),
                            sales, fx["regions"])
    rec = P.recipients(fx["raw"], name_map, geo)
    return rec, fx["regions"], fact, P.lab_top_products(bridge)


def names(df):
    return [(r["nom"], r["labo_normalise"], r["priority"]) for r in df.collect()]


def test_search_name_contains_and_priority(s):
    got = P.search_recipients(*s, "mart")
    assert names(got) == [("MARTIN", "LABORATOIRES PFIZER", 2), ("MARTIN", "PFIZER", 2)]
    row = got.where(F.col("labo_normalise") == "PFIZER").first()
    assert row["roi"] == 3.0 and row["part_de_marche"] == 100.0 and row["medocs"] == "BETA"
    other = got.where(F.col("labo_normalise") == "LABORATOIRES PFIZER").first()
    assert other["roi"] == 0.0 and other["medocs"] == "BETA FORT"


def test_search_exact_name_first(s):
    got = P.search_recipients(*s, "durand").collect()
    assert [(r["nom"], r["priority"]) for r in got] == [("DURAND", 1)]


def test_search_city_prefix_needs_long_term(s):
    assert P.search_recipients(*s, "lyo").count() == 0
    assert {r["nom"] for r in P.search_recipients(*s, "lyon").collect()} == {"MARTIN"}


def test_search_short_term_returns_nothing(s):
    assert P.search_recipients(*s, "r").count() == 0


def test_search_unmatched_row_gets_defaults(s):
    r = P.search_recipients(*s, "petit").first()
    assert r["roi"] == 0.0 and r["medocs"] == "leurs traitements brevetés"


def test_search_wildcards_and_backslash(s):
    assert P.search_recipients(*s, "M_RTIN").count() == 2
    assert P.search_recipients(*s, "M_RTIN", literal=True).count() == 0
    assert P.search_recipients(*s, "a\\b").count() == 0      # no error on a backslash


def test_search_limit(s):
    rec = s[0]
    assert P.search_recipients(*s, "r", min_len=1, k=2).count() == 2
    assert rec.count() == 5


def test_batch_equals_single_search(spark, s):
    terms = ["mart", "durand", "lyon", "ro", "ou", "zz"]
    tdf = spark.createDataFrame([(t,) for t in terms], "term string")
    batch = P.search_recipients_batch(*s, tdf, k=2)
    for t in terms:
        single = P.search_recipients(*s, t, literal=True, k=2).drop("priority")
        b = batch.where(F.col("term") == t).drop("term", "rank", "priority")
        assert rows(b, *single.columns) == rows(single), t


def test_batch_rank_is_ordered(spark, s):
    tdf = spark.createDataFrame([("r",), ("ar",)], "term string")
    got = P.search_recipients_batch(*s, tdf, min_len=1).where(F.col("term") == "r")
    ranked = sorted(got.collect(), key=lambda r: r["rank"])
    amounts = [(r["priority"], -float(r["montant_total"])) for r in ranked]
    assert amounts == sorted(amounts)


def test_landing_top_groups(s):
    top = P.landing_stats(s[0], k=2).top_groups.collect()
    assert [(r["groupe"], r["total"]) for r in top] == [("BAYER SANTE", 5000.0), ("PFIZER SAS", 2500.5)]


def test_recipient_report(s):
    res = P.search_recipients(*s, "roux")
    r = P.recipient_report(res).first()
    assert r["title"] == "ROUX EVE"
    assert r["subtitle"] == "BOURG — Institution"
    assert r["amount_label"] == "5\u202f000 €"
    assert r["roi_rounded"] == 10 and r["message"] == "influence"
    assert r["funding_text"] == ("Cet acteur a perçu un financement cumulé de 5\u202f000 € de la part du laboratoire "
                                 "BAYER SANTE.")
    assert "rembourse au laboratoire 10 € de médicaments" in r["message_text"]
    assert "100% des prescriptions" in r["share_text"] and "(ex: GAMMA)" in r["share_text"]
    note = P.recipient_report(P.search_recipients(*s, "petit")).first()
    assert note["message_text"].startswith("Note : Ce financement concerne la recherche.") and note["share_text"] is None


def no_broadcasts(spark):
    return {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                                 "spark.sql.adaptive.autoBroadcastJoinThreshold")}


def sort_key(r):
    last = lambda v: (v is None, v or "")
    return (r["priority"], -r["montant_total"], *(last(r[c]) for c in (
        "nom", "prenom", "ville", "specialite", "labo_source", "labo_normalise", "region_code")))


@pytest.mark.parametrize("broadcasts", [True, False])
def test_results_come_in_order(spark, broadcasts):
    """Rows are sorted after the enrichment, however its joins run, in both forms of the search."""
    from suite.queries import QUERIES
    saved = no_broadcasts(spark)
    try:
        if not broadcasts:
            for k in saved:
                spark.conf.set(k, "-1")
        for name in ("search_limit", "search_mart"):
            got = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
            assert len(got) == 15
            assert got == sorted(got, key=sort_key), name
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_search_from_declarations_equals_the_mart_search(spark, fx, s):
    stg = P.stg_declarations(fx["raw"])
    bridge = P.product_bridge(fx["packs"], fx["products"])
    name_map = P.lab_name_map(stg, bridge)
    for q, k in (("mart", 15), ("mart", 1), ("durand", 5), ("lyon", 5), ("ro", 1), ("zz", 5), ("r", 5), ("a\\b", 5)):
        a = P.search_recipients(*s, q, k=k).collect()
        b = P.search_declarations(fx["raw"], name_map, fx["depts"], fx["regions"], fx["rx"], bridge,
                                  P.lab_top_products(bridge), q, k=k).collect()
        pick = lambda rs: [(r["nom"], r["labo_normalise"], r["region_code"], r["priority"], r["medocs"]) for r in rs]
        assert pick(a) == pick(b), q


def test_batch_of_a_hot_gram(spark, s):
    """A gram that every name has: the shuffled path gives what the single searches give."""
    rec = spark.createDataFrame(
        [(f"HOTNAME{i:04d}", "A", "PARISTOWN", "x", "PFIZER SAS", "PFIZER", "84", float(i)) for i in range(600)],
        "nom string, prenom string, ville string, specialite string, labo_source string, labo_normalise string, "
        "region_code string, montant_total double")
    terms = ["hotname", "ot", "name0001", "paristown", "hotname0599", "zzz", "h"]
    saved = no_broadcasts(spark)
    try:
        for k in saved:
            spark.conf.set(k, "-1")
        batch = P.search_recipients_batch(rec, *s[1:], spark.createDataFrame([(t,) for t in terms], "term string"))
        got = {}
        for r in batch.collect():
            got.setdefault(r["term"], []).append((r["rank"], r["nom"], r["priority"]))
        for t in terms:
            single = P.search_recipients(rec, *s[1:], t, literal=True).collect()
            assert sorted(got.get(t, [])) == [(i + 1, r["nom"], r["priority"]) for i, r in enumerate(single)], t
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_batch_without_usable_terms_keeps_schema(spark, s):
    tdf = spark.createDataFrame([("a",)], "term string")
    out = P.search_recipients_batch(*s, tdf)
    full = P.search_recipients_batch(*s, spark.createDataFrame([("mart",)], "term string"))
    assert out.count() == 0 and out.columns == full.columns


def test_search_runs_on_the_geo_recipient_table(spark, fx, s):
    pts = spark.createDataFrame([("75011", "48.85, 2.38"), ("69003", "45.76, 4.85")],
                                "`Code Postal` string, geo_point_2d string")
    stg = P.stg_declarations(fx["raw"])
    bridge = P.product_bridge(fx["packs"], fx["products"])
    rec_geo = P.recipients_geo(fx["raw"], P.lab_name_map(stg, bridge), P.geo_ref(pts, fx["depts"]))
    got = P.search_recipients(rec_geo, s[1], s[2], s[3], "durand").collect()
    assert [(r["nom"], r["prenom"], r["latitude"], r["priority"]) for r in got] == [
        ("DURAND", "ANNE", 48.85, 1)]
    assert float(got[0]["montant_total"]) == 2701.0      # no de-duplication in this table
