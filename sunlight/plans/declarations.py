"""Payment declarations: staging, clean-up, geography, reports
(MRT-1, MRT-2, MRT-3, QRY-6)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from sunlight.functions import (department_code, parse_comma_decimal, speciality_label,
                                DEFAULT_SPECIALITY_RULES)
from sunlight.operators import top_k
from sunlight.plans.columns import RAW, DeclarationColumns

STG_COLUMNS = ["labo", "nom", "prenom", "specialite", "ville", "montant", "date", "motif"]


def stg_declarations(raw: DataFrame, cols: DeclarationColumns = RAW,
                     strict: bool = True) -> DataFrame:
    """MRT-1: renamed columns, amount parsed to DECIMAL(18,2), NULL amounts
    dropped. The date stays text, as in the source."""
    return (raw.where(F.col(cols.amount).isNotNull())
            .select(F.col(cols.company).alias("labo"),
                    F.col(cols.name).alias("nom"),
                    F.col(cols.first_name).alias("prenom"),
                    F.col(cols.profession).alias("specialite"),
                    F.col(cols.city).alias("ville"),
                    parse_comma_decimal(cols.amount, strict=strict).alias("montant"),
                    F.col(cols.date).cast("string").alias("date"),
                    F.col(cols.motive).alias("motif")))


def clean_specialities(stg: DataFrame, rules=DEFAULT_SPECIALITY_RULES,
                       column: str = "specialite") -> DataFrame:
    """MRT-2: collapse profession labels (ILIKE rules, first match wins)."""
    return stg.withColumn(column, speciality_label(column, rules))


def raw_departments(raw: DataFrame, cols: DeclarationColumns = RAW,
                    dedup: bool = True) -> DataFrame:
    """(identite, date, dept) of every raw declaration; distinct by default."""
    geo = raw.select(F.col(cols.name).alias("_g_name"),
                     F.col(cols.date).cast("string").alias("_g_date"),
                     department_code(cols.postal_code).alias("_g_dept"))
    return geo.distinct() if dedup else geo


def declarations_geo(stg: DataFrame, raw: DataFrame, dept_region: DataFrame,
                     cols: DeclarationColumns = RAW, dedup: bool = True) -> DataFrame:
    """MRT-3: staging rows + the region of the declarant's department.

    Staging rows find their department by (name, date) in the raw export;
    with ``dedup`` the raw side is first reduced to distinct
    (name, date, department), so k raw rows sharing a key no longer fan a
    staging row out k times. A key with several departments still yields
    one row per department (left-join semantics).
    """
    geo = raw_departments(raw, cols, dedup)
    cond = (F.col("s.nom") == F.col("g._g_name")) & (F.col("s.date") == F.col("g._g_date"))
    return (stg.alias("s").join(geo.alias("g"), cond, "left")
            .join(dept_region.alias("d"), F.col("g._g_dept") == F.col("d.dept_code"), "left")
            .select(*[F.col(f"s.{c}") for c in stg.columns], F.col("d.region_code")))


def recipient_regions(stg: DataFrame, raw: DataFrame, dept_region: DataFrame,
                      cols: DeclarationColumns = RAW, only: DataFrame | None = None) -> DataFrame:
    """(nom, ville, region_code) rows whose per-(nom, ville) MAX equals the
    one taken over ``declarations_geo``.

    MAX ignores duplicates, so the staging side is first reduced to distinct
    (name, city, date) - a partial aggregate before the shuffle - and only
    those keys are joined to the department list. Use it in place of
    ``declarations_geo`` for the recipients' region lookup when that mart
    is not already materialised. ``only`` (columns nom, ville) limits it to these
    recipients; the raw side is then limited to their names before it is
    reduced.
    """
    keys = stg.select("nom", "ville", "date").distinct()
    if only is not None:
        wanted = only.select("nom", "ville").distinct()
        keys = keys.join(wanted, ["nom", "ville"], "left_semi")
        raw = raw.join(wanted.select(F.col("nom").alias(cols.name)).distinct(), cols.name, "left_semi")
    geo = raw_departments(raw, cols)
    cond = (F.col("k.nom") == F.col("g._g_name")) & (F.col("k.date") == F.col("g._g_date"))
    return (keys.alias("k").join(geo.alias("g"), cond, "left")
            .join(dept_region.alias("d"), F.col("g._g_dept") == F.col("d.dept_code"), "left")
            .select("k.nom", "k.ville", F.col("d.region_code")))


class PaymentReport(NamedTuple):
    companies: DataFrame
    professions: DataFrame
    motives: DataFrame


def _money_sum(c: str = "montant"):
    return F.sum(c).cast("decimal(38,2)")


def top_companies(stg: DataFrame, k: int = 5) -> DataFrame:
    """AGG-1: amount and number of declarations per company, top k."""
    agg = stg.groupBy("labo").agg(_money_sum().alias("total_euros"),
                                  F.count(F.lit(1)).alias("nb_declarations"))
    return top_k(agg, [F.desc_nulls_last("total_euros"), F.asc_nulls_last("labo")], k)


def top_professions(stg: DataFrame, k: int = 5) -> DataFrame:
    """AGG-2: amount per (non-NULL) profession, top k."""
    agg = (stg.where(F.col("specialite").isNotNull())
           .groupBy("specialite").agg(_money_sum().alias("total_euros")))
    return top_k(agg, [F.desc_nulls_last("total_euros"), F.asc_nulls_last("specialite")], k)


def top_motives(stg: DataFrame, k: int = 5) -> DataFrame:
    """AGG-3: count and amount per motive, top k by amount."""
    agg = stg.groupBy("motif").agg(F.count(F.lit(1)).alias("nb_fois"),
                                   _money_sum().alias("total_euros"))
    return top_k(agg, [F.desc_nulls_last("total_euros"), F.asc_nulls_last("motif")], k)


def payment_report(stg: DataFrame, k: int = 5) -> PaymentReport:
    """QRY-6: the three staging reports."""
    return PaymentReport(top_companies(stg, k), top_professions(stg, k), top_motives(stg, k))


def speciality_summary(stg: DataFrame) -> DataFrame:
    """Count and amount per (cleaned) profession label."""
    return stg.groupBy("specialite").agg(F.count(F.lit(1)).alias("nb_declarations"),
                                         _money_sum().alias("total_euros"))
