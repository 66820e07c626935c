"""FIXTURES.md section C: a small end-to-end input, as DataFrames."""

from __future__ import annotations

from pyspark.sql import SparkSession

RAW_COLS = ["raison_sociale", "identite", "prenom", "profession_libelle", "ville",
            "code_postal", "montant", "date", "motif_lien_interet"]

_R1 = ("SANOFI AVENTIS FRANCE", "DURAND", "ANNE", "Médecin généraliste", "PARIS", "75011",
       "1200,50", "2022-01-05", "Hospitalité - restauration")
DECLARATIONS = [
    _R1,
    _R1,
    ("SANOFI AVENTIS FRANCE", "DURAND", "ANNE", "Médecin généraliste", "PARIS", "75011",
     "300", "2022-02-01", "Frais de transport"),
    ("PFIZER SAS", "MARTIN", "null", "Pharmacien titulaire", "LYON", "69003", "800,00",
     "2022-03-01", "Hospitalité - hébergement"),
    ("PFIZER SAS", "MARTIN", "null", "Pharmacien titulaire", "LYON", "69003", "450,25",
     "2022-03-02", "Autre motif"),
    ("Laboratoires Théa", "PETIT", "LUC", "Docteur en médecine", "AJACCIO", "20000", "900",
     "2022-04-01", "Hospitalité - restauration"),
    ("BAYER SANTE", "ROUX", "EVE", None, "BOURG", "1000", "5000", "2022-05-01",
     "Frais de transport"),
    ("PFIZER SAS", "MARTIN", "null", "Pharmacien titulaire", "LYON", "69003", None,
     "2022-06-01", "Frais de transport"),
]

PRODUCTS = [("100", " ALPHA 5 mg ", "Sanofi Aventis"), ("200", "BETA", "PFIZER"),
            ("201", "BETA FORT", "Laboratoires Pfizer"), ("300", "GAMMA", "BAYER SANTE"),
            ("301", "DELTA", None)]
PACKS = [("100 ", "3400000000001"), ("200", "3400000000002"), ("201", " 3400000000003"),
         ("300", "3400000000004"), ("301", "3400000000005"), ("300", "")]


def cip(d: int) -> str:
    return f"340000000000{d}"


PRESCRIPTIONS = [
    ("11", "1", cip(1), "0", "1.000", "12.345,50"),
    ("11", "1", cip(1), "1", "10", "1.000,00"),
    ("84", "3", cip(2), "0", "5", "2.500,25"),
    ("84", "x", cip(3), "1", "2", "100,00"),
    ("84", "99", cip(4), "0", None, "50.000,00"),
    (None, "1", cip(1), "0", "1", "9,99"),
    ("93", "12", cip(9), "0", "1", "7,00"),
]

DEPTS = [("75", "11"), ("69", "84"), ("01", "84"), ("2A", "94")]
REGIONS = [("11", "Île-de-France"), ("84", "Auvergne-Rhône-Alpes"),
           ("93", "Provence-Alpes-Côte d Azur"), ("94", "Corse")]
SPECIALITIES = [(1, "Médecine Générale"), (3, "Pathologie Cardio-Vasculaire"), (12, "Pédiatrie")]
MOTIVES = ("Hospitalité - restauration", "Hospitalité - hébergement", "Frais de transport")


def frames(spark: SparkSession) -> dict:
    s = lambda cols: ", ".join(f"{c} string" for c in cols)
    rx = spark.createDataFrame(PRESCRIPTIONS, s(["ben_reg", "psp_spe", "cip13", "top_gen",
                                                 "boites", "rem"]))
    rx = rx.withColumn("l_cip13", rx["cip13"]).withColumn("pfs_exe_num", rx["psp_spe"])
    return {
        "raw": spark.createDataFrame(DECLARATIONS, s(RAW_COLS)),
        "products": spark.createDataFrame(PRODUCTS, s(["cis", "nom_medicament", "labo_ansm"])),
        "packs": spark.createDataFrame(PACKS, s(["cis", "cip13"])),
        "rx": rx,
        "depts": spark.createDataFrame(DEPTS, "dept_code string, region_code string"),
        "regions": spark.createDataFrame(REGIONS, "code string, libelle_reg string"),
        "specialities": spark.createDataFrame(SPECIALITIES, "code int, libelle string"),
    }
