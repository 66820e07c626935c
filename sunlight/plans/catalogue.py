"""Product catalogue: pack -> product -> company bridge and company
dimensions (MRT-6, MRT-12, MRT-13, AGG-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sunlight.operators import ranked_string_agg, top_k, top_k_per_group
from sunlight.sources.files import read_tolerant_tsv

# Positions in the two catalogue exports (products / packs).
PRODUCT_POSITIONS = {0: "cis", 1: "nom_medicament", 10: "labo_ansm"}
PACK_POSITIONS = {0: "cis", 6: "cip13"}


def load_catalogue(spark: SparkSession, products_path: str, packs_path: str,
                   product_positions=PRODUCT_POSITIONS, pack_positions=PACK_POSITIONS,
                   encoding: str = "ISO-8859-1"):
    """Read both Latin-1 catalogue exports with the tolerant TSV reader."""
    return (read_tolerant_tsv(spark, products_path, product_positions, encoding=encoding),
            read_tolerant_tsv(spark, packs_path, pack_positions, encoding=encoding))


def product_bridge(packs: DataFrame, products: DataFrame, upper_company: bool = True) -> DataFrame:
    """MRT-6: (cip13, nom_medicament, labo_ansm), joined on trimmed product id.

    Packs with a NULL or empty code and products without a company are
    left out; the emptiness test is on the untrimmed code, as in the source.
    """
    p = (packs.where(F.col("cip13").isNotNull() & (F.col("cip13") != ""))
         .select(F.trim("cis").alias("_cis"), F.trim("cip13").alias("cip13")))
    company = F.trim("labo_ansm")
    c = (products.where(F.col("labo_ansm").isNotNull())
         .select(F.trim("cis").alias("_cis"),
                 F.trim("nom_medicament").alias("nom_medicament"),
                 (F.upper(company) if upper_company else company).alias("labo_ansm")))
    return p.join(c, "_cis").select("cip13", "nom_medicament", "labo_ansm")


def lab_dim(bridge: DataFrame) -> DataFrame:
    """MRT-12: one row per company: an example product and its pack count."""
    return (bridge.groupBy(F.col("labo_ansm").alias("labo_id"))
            .agg(F.min("nom_medicament").alias("exemple_produit"),
                 F.countDistinct("cip13").alias("nb_references")))


def lab_top_products(bridge: DataFrame, k: int = 3, sep: str = " | ") -> DataFrame:
    """MRT-13: the k products with most packs per company, as one string.

    Ties on the pack count are broken by product name so the choice is
    deterministic. Only k rows per company survive the ranking, so the
    string aggregation handles bounded groups.
    """
    counts = bridge.groupBy("labo_ansm", "nom_medicament").agg(F.count(F.lit(1)).alias("nb_refs"))
    ranked = top_k_per_group(counts, ["labo_ansm"],
                             [F.desc("nb_refs"), F.asc_nulls_last("nom_medicament")], k)
    return ranked_string_agg(ranked, ["labo_ansm"], "rank", "nom_medicament", sep, "top_produits")


def catalogue_top(bridge: DataFrame, k: int = 5) -> DataFrame:
    """AGG-9: packs per company, top k."""
    agg = bridge.groupBy("labo_ansm").agg(F.count(F.lit(1)).alias("nb"))
    return top_k(agg, [F.desc("nb"), F.asc_nulls_last("labo_ansm")], k)
