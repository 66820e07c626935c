"""FIXTURES.md section C: whole marts on a small hand-made input."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

import fixture_c as C
from conftest import rows
from sunlight import plans as P


@pytest.fixture(scope="module")
def m(spark, fx):
    stg = P.stg_declarations(fx["raw"])
    geo = P.declarations_geo(stg, fx["raw"], fx["depts"])
    bridge = P.product_bridge(fx["packs"], fx["products"])
    name_map = P.lab_name_map(stg, bridge)
    sales = P.sales_mart(fx["rx"], bridge)
    spend = P.influence_spend(stg, name_map, fx["raw"], fx["depts"], C.MOTIVES)
    fact = P.influence_fact(spend, sales, fx["regions"])
    return dict(stg=stg, geo=geo, bridge=bridge, name_map=name_map, sales=sales, spend=spend,
                fact=fact)


def cip(d):
    return C.cip(d)


def test_staging_drops_null_amounts(m):
    assert m["stg"].count() == 7
    assert rows(m["stg"].where(F.col("nom") == "PETIT"), "montant") == [(D("900.00"),)]


def test_declarations_geo(m):
    got = rows(m["geo"], "nom", "date", "region_code")
    assert len(got) == 7
    assert [r for r in got if r[0] == "PETIT"] == [("PETIT", "2022-04-01", None)]
    assert {r[2] for r in got if r[0] == "DURAND"} == {"11"}
    assert {r[2] for r in got if r[0] in ("MARTIN", "ROUX")} == {"84"}


def test_declarations_geo_without_dedup_fans_out(m, fx):
    raw_geo = P.declarations_geo(m["stg"], fx["raw"], fx["depts"], dedup=False)
    assert raw_geo.count() == 9          # rows 1 and 2 become 2 x 2


def test_product_bridge(m):
    assert rows(m["bridge"]) == [(cip(1), "ALPHA 5 mg", "SANOFI AVENTIS"), (cip(2), "BETA", "PFIZER"),
                                 (cip(3), "BETA FORT", "LABORATOIRES PFIZER"),
                                 (cip(4), "GAMMA", "BAYER SANTE")]


def test_lab_name_map(m):
    assert rows(m["name_map"]) == [("BAYER SANTE", "BAYER SANTE"), ("PFIZER SAS", "LABORATOIRES PFIZER"),
                                   ("PFIZER SAS", "PFIZER"),
                                   ("SANOFI AVENTIS FRANCE", "SANOFI AVENTIS")]


def test_prescriptions_mart(spark, fx):
    mart = P.prescriptions_mart(fx["rx"], fx["regions"], fx["specialities"])
    got = rows(mart, "code_region", "code_spe", "specialite", "total_boites")
    assert len(got) == 7
    assert ("84", "99", "Autre / Inconnu", None) in got
    assert ("84", "x", "Autre / Inconnu", D("2.000")) in got
    assert (None, "1", "Médecine Générale", D("1.000")) in got
    top = P.region_top(mart).collect()
    assert top[0]["region"] == "Auvergne-Rhône-Alpes" and top[0]["total"] == D("52600.25")


def test_sales_mart(m):
    assert rows(m["sales"]) == [
        ("11", cip(1), "0", "SANOFI AVENTIS", 1000.0, 12345.5),
        ("11", cip(1), "1", "SANOFI AVENTIS", 10.0, 1000.0),
        ("84", cip(2), "0", "PFIZER", 5.0, 2500.25),
        ("84", cip(3), "1", "LABORATOIRES PFIZER", 2.0, 100.0),
        ("84", cip(4), "0", "BAYER SANTE", 0.0, 50000.0)]


def test_influence_spend_counts_fanout(m):
    assert rows(m["spend"]) == [("BAYER SANTE", "84", D("5000.00")),
                                ("LABORATOIRES PFIZER", "84", D("800.00")),
                                ("PFIZER", "84", D("800.00")),
                                ("SANOFI AVENTIS", "11", D("2701.00"))]


def test_influence_fact(m):
    got = rows(m["fact"], "labo", "region", "total_cadeaux", "ventes_princeps", "total_ventes",
               "pct_princeps", "roi_influence")
    assert got == [
        ("BAYER SANTE", "Auvergne-Rhône-Alpes", D("5000.00"), 50000.0, 50000.0, 100.0, 10.0),
        ("LABORATOIRES PFIZER", "Auvergne-Rhône-Alpes", D("800.00"), 0.0, 100.0, 0.0, 0.0),
        ("PFIZER", "Auvergne-Rhône-Alpes", D("800.00"), 2500.25, 2500.25, 100.0, 3.0),
        ("SANOFI AVENTIS", "Île-de-France", D("2701.00"), 12345.5, 13345.5, 92.5, 5.0)]


def test_influence_fact_first_form(m, fx):
    v1 = P.influence_fact(m["spend"], m["sales"], fx["regions"], min_spend=1000, brand_only=True)
    assert v1.columns == ["labo", "region", "total_cadeaux", "ventes_princeps", "roi_influence"]
    assert rows(v1, "labo", "roi_influence") == [("BAYER SANTE", 10.0), ("SANOFI AVENTIS", 5.0)]


def test_influence_groups(m):
    got = rows(P.influence_groups(m["fact"], min_spend=0))
    assert got == [("BAYER", D("5000.00"), 50000.0, 10.0), ("PFIZER", D("1600.00"), 2500.25, 2.0),
                   ("SANOFI/OPELLA", D("2701.00"), 12345.5, 5.0)]
    assert P.influence_groups(m["fact"]).count() == 0


def test_recipients(m, fx):
    rec = P.recipients(fx["raw"], m["name_map"], m["geo"])
    assert rows(rec, "nom", "prenom", "ville", "montant_total", "labo_normalise", "region_code") == [
        ("DURAND", "ANNE", "PARIS", D("1500.50"), "SANOFI AVENTIS", "11"),
        ("MARTIN", "null", "LYON", D("1250.25"), "LABORATOIRES PFIZER", "84"),
        ("MARTIN", "null", "LYON", D("1250.25"), "PFIZER", "84"),
        ("PETIT", "LUC", "AJACCIO", D("900.00"), None, None),
        ("ROUX", "EVE", "BOURG", D("5000.00"), "BAYER SANTE", "84")]
    total = P.landing_stats(rec).total.first()["total_global"]
    assert total == pytest.approx(9901.0)
    assert P.landing_stats(rec, fallback=9.5e9).total.first()["total_global"] == pytest.approx(9901.0)


def test_recipients_without_dedup_counts_copies(m, fx):
    rec = P.recipients(fx["raw"], m["name_map"], m["geo"], dedup=False)
    durand = rec.where(F.col("nom") == "DURAND").first()
    assert durand["montant_total"] == D("2701.00")


def test_catalogue_dims(m):
    assert rows(P.lab_dim(m["bridge"])) == [("BAYER SANTE", "GAMMA", 1),
                                            ("LABORATOIRES PFIZER", "BETA FORT", 1),
                                            ("PFIZER", "BETA", 1), ("SANOFI AVENTIS", "ALPHA 5 mg", 1)]
    assert rows(P.lab_top_products(m["bridge"]))[0] == ("BAYER SANTE", "GAMMA")


def test_clean_specialities(m):
    got = rows(P.clean_specialities(m["stg"]), "specialite")
    assert {g[0] for g in got} == {None, "Médecin", "Pharmacien"}


def test_payment_report(m):
    rep = P.payment_report(m["stg"])
    assert rep.companies.first()["labo"] == "BAYER SANTE"
    assert rows(rep.motives, "motif", "nb_fois") == [("Autre motif", 1), ("Frais de transport", 2),
                                                     ("Hospitalité - hébergement", 1),
                                                     ("Hospitalité - restauration", 3)]


def test_geo_ref_first_point_and_region(spark, fx):
    pts = spark.createDataFrame([("1000", "46.3, 5.3"), ("01000", "46.2, 5.2"), ("75011", None),
                                 ("20000", "41.9, 8.7"), ("69003", "45.7, 4.8")],
                                "`Code Postal` string, geo_point_2d string")
    g = P.geo_ref(pts, fx["depts"])
    assert rows(g) == [("01000", 46.2, 5.2, "84"), ("69003", 45.7, 4.8, "84")]


def test_build_marts_writes_every_table(spark, fx):
    from sunlight.session import scratch_path
    pts = spark.createDataFrame([("01000", "46.2, 5.2"), ("69003", "45.7, 4.8")],
                                "`Code Postal` string, geo_point_2d string")
    out = scratch_path(spark, "marts")
    paths = P.build_marts(spark, out, fx["raw"], fx["rx"], fx["products"], fx["packs"],
                          fx["depts"], fx["regions"], fx["specialities"], geo_points=pts)
    assert set(paths) >= {"stg_declarations", "influence_fact", "recipients", "recipients_geo",
                          "lab_top_products", "influence_groups"}
    fact = spark.read.parquet(paths["influence_fact"])
    assert rows(fact, "labo", "roi_influence") == [("BAYER SANTE", 10.0), ("LABORATOIRES PFIZER", 0.0),
                                                   ("PFIZER", 3.0), ("SANOFI AVENTIS", 5.0)]
    assert spark.read.parquet(paths["recipients"]).count() == 5


def test_name_map_fanout_is_reported(m):
    from sunlight.operators import join_fanout
    rep = join_fanout(m["stg"], m["name_map"], m["stg"].labo == m["name_map"].name_transparence,
                      "montant").first()
    # 7 staged rows; PFIZER SAS maps to two catalogue names, Laboratoires Théa to none
    assert rep["rows_before"] == 7 and rep["rows_after"] == 8
    assert rep["amount_before"] == D("9851.25")
    assert rep["amount_after"] == D("9851.25") - D("900.00") + D("800.00") + D("450.25")
    assert rep["fanout"] == 8 / 7


def test_fanout_of_an_empty_side(spark, m):
    from sunlight.operators import join_fanout
    none = m["stg"].limit(0)
    rep = join_fanout(none, m["name_map"], none["labo"] == m["name_map"].name_transparence, "montant").first()
    assert rep["rows_before"] == 0 and rep["fanout"] is None


def test_clean_professions_are_a_mart(spark, fx):
    from sunlight.session import scratch_path
    paths = P.build_marts(spark, scratch_path(spark, "marts-clean"), fx["raw"], fx["rx"], fx["products"], fx["packs"],
                          fx["depts"], fx["regions"], fx["specialities"])
    labels = {r["specialite"] for r in spark.read.parquet(paths["stg_declarations_clean"]).collect()}
    assert labels == {None, "Médecin", "Pharmacien"}
    assert "Médecin généraliste" in {r["specialite"] for r in spark.read.parquet(paths["stg_declarations"]).collect()}


def test_reports_are_in_order(m):
    groups = P.groups_preview(P.influence_groups(m["fact"], min_spend=0), k=2).collect()
    assert [(r["rang"], r["groupe"]) for r in groups] == [(1, "BAYER"), (2, "SANOFI/OPELLA")]
    focus = P.company_focus(m["fact"], ("%PFIZER%", "%BAYER%")).collect()
    assert [(r["rang"], r["labo"]) for r in focus] == [(1, "BAYER SANTE"), (2, "PFIZER"), (3, "LABORATOIRES PFIZER")]


def test_sales_of_given_companies(spark, m, fx):
    few = spark.createDataFrame([("PFIZER",)], "labo string")
    assert rows(P.sales_mart(fx["rx"], m["bridge"], companies=few)) == [r for r in rows(m["sales"]) if r[3] == "PFIZER"]
    spend = P.influence_spend(m["stg"], m["name_map"], fx["raw"], fx["depts"], C.MOTIVES, companies=few)
    assert rows(spend) == [("PFIZER", "84", D("800.00"))]
    wide = P.sales_mart(fx["rx"], m["bridge"], number="decimal(24,6)")
    assert rows(wide) == rows(m["sales"])


def test_build_marts_rerun_is_idempotent(spark, fx):
    from sunlight.session import scratch_path
    out = scratch_path(spark, "marts-rerun")
    args = (fx["raw"], fx["rx"], fx["products"], fx["packs"], fx["depts"], fx["regions"],
            fx["specialities"])
    first = P.build_marts(spark, out, *args)
    snap = {k: rows(spark.read.parquet(v)) for k, v in first.items()}
    second = P.build_marts(spark, out, *args)
    assert first == second
    assert {k: rows(spark.read.parquet(v)) for k, v in second.items()} == snap


def test_views_over_marts(spark, m):
    from sunlight.sources import register_views
    register_views({"fact_view": m["fact"]})
    got = spark.sql("SELECT labo FROM fact_view WHERE roi_influence > 4 ORDER BY labo").collect()
    assert [r["labo"] for r in got] == ["BAYER SANTE", "SANOFI AVENTIS"]


def test_recipient_regions_give_the_same_lookup(m, fx):
    lean = P.recipient_regions(m["stg"], fx["raw"], fx["depts"])
    a = P.recipients(fx["raw"], m["name_map"], m["geo"])
    b = P.recipients(fx["raw"], m["name_map"], lean)
    assert rows(a) == rows(b)


def test_recipients_keep_raw_professions_unless_cleaned(m, fx):
    from sunlight.functions import DEFAULT_SPECIALITY_RULES
    raw_labels = {r["specialite"] for r in P.recipients(fx["raw"], m["name_map"], m["geo"]).collect()}
    assert "Médecin généraliste" in raw_labels
    cleaned = P.recipients(fx["raw"], m["name_map"], m["geo"], clean_rules=DEFAULT_SPECIALITY_RULES)
    labels = {r["specialite"] for r in cleaned.collect()}
    assert labels == {"Médecin", "Pharmacien", None}
