"""Spend x sales: company-name map, spend per company and region, the
influence fact, group roll-up and reports (MRT-7, MRT-9, MRT-10, MRT-11,
QRY-4, QRY-5)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from sunlight.functions import (DEFAULT_GROUP_RULES, LAB_NAME_PATTERN, group_key,
                                normalise_lab_name, round_half_up, safe_div)
from sunlight.operators import in_key_set, key_set, number_rows, ranked_top_k, top_k
from sunlight.plans.columns import RAW, DeclarationColumns
from sunlight.plans.declarations import raw_departments

# --- fixed values: payment motives counted as direct influence -------------
INFLUENCE_MOTIVES = (
    "Hospitalité - restauration",
    "Hospitalité - hébergement",
    "Frais de transport",
    "Frais d'inscription à une manifestation",
    "Contrat de participation à une manifestation",
)
# ---------------------------------------------------------------------------

DEPARTMENT_KEY_BITS = 1 << 26            # 8 MB, sent to every task


def _names(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return (df.select(F.col(column).alias("orig")).distinct()
            .select("orig", F.trim(normalise_lab_name("orig", pattern)).alias("key")))


def lab_name_map(declarations: DataFrame, bridge: DataFrame,
                 pattern: str = LAB_NAME_PATTERN, min_len: int = 3) -> DataFrame:
    """MRT-7: (name_transparence, name_ansm) pairs whose normalised names
    are equal and longer than ``min_len`` characters.

    Both sides are first reduced to distinct names, so the join runs on two
    name lists, not on payment rows. The map is many-to-many by nature: one
    payer may match several catalogue names and vice versa.
    """
    t = _names(declarations, "labo", pattern).where(F.length("key") > min_len)
    a = _names(bridge, "labo_ansm", pattern)
    return (t.alias("t").join(a.alias("a"), F.col("t.key") == F.col("a.key"))
            .select(F.col("t.orig").alias("name_transparence"),
                    F.col("a.orig").alias("name_ansm")))


def influence_spend(stg: DataFrame, name_map: DataFrame, raw: DataFrame,
                    dept_region: DataFrame, motives: Sequence[str] = INFLUENCE_MOTIVES,
                    cols: DeclarationColumns = RAW, companies: DataFrame | None = None,
                    reduce_departments: bool = False, located: DataFrame | None = None) -> DataFrame:
    """MRT-9: influence spend per (catalogue company, region).

    A payment counts once per catalogue name its payer maps to and once per
    department its declarant has on that date - the joins' semantics.

    With the name map as a written mart the planner broadcasts it below the
    session's threshold, so payments are not shuffled by payer (the natural hot
    key); the one shuffle of the payment rows is the (name, date) join with the
    department list, where AQE splits a skewed key. ``companies`` (column
    ``labo``) keeps only these catalogue companies, and so only the payments of
    their payers.

    The department list comes from all declarations, though only payments of some
    motives and payers ask for it. With ``reduce_departments`` a key set of fixed size
    (``DEPARTMENT_KEY_BITS``) of the asking (name, date) pairs drops most other declarations before
    they are reduced and shuffled, at the price of one more scan of ``stg``: worth it where
    that is a stored table and few payments ask.

    ``located`` is the stored ``declarations_geo`` mart of the same declarations: its rows are
    the payments already joined with their departments' regions, so that join is not done
    again. ``dept_region`` must then list no department without a region.
    """
    if companies is not None:
        name_map = name_map.join(companies.select(F.col("labo").alias("name_ansm")), "name_ansm", "left_semi")
    if located is not None:
        asking = located.where(F.col("motif").isin(list(motives)) & F.col("region_code").isNotNull())
        return (asking.alias("t").join(name_map.alias("m"), F.col("t.labo") == F.col("m.name_transparence"))
                .groupBy(F.col("m.name_ansm").alias("labo_ansm"), F.col("t.region_code"))
                .agg(F.sum("t.montant").cast("decimal(38,2)").alias("total_cadeaux")))
    asking = stg.where(F.col("motif").isin(list(motives)))
    if reduce_departments:
        payers = name_map.select(F.col("name_transparence").alias("labo")).distinct()
        keys = asking.join(payers, "labo", "left_semi").select("nom", F.col("date").cast("string").alias("date"))
        raw = (raw.withColumn("_asked", key_set(keys, "nom", "date", bits=DEPARTMENT_KEY_BITS))
               .where(in_key_set(F.col("_asked"), F.col(cols.name), F.col(cols.date).cast("string"), bits=DEPARTMENT_KEY_BITS))
               .drop("_asked"))
    geo = raw_departments(raw, cols, dedup=True)
    j = (asking.alias("t")
         .join(name_map.alias("m"), F.col("t.labo") == F.col("m.name_transparence"))
         .join(geo.alias("v"), (F.col("t.nom") == F.col("v._g_name"))
               & (F.col("t.date") == F.col("v._g_date")))
         .join(dept_region.alias("r"), F.col("v._g_dept") == F.col("r.dept_code")))
    return (j.groupBy(F.col("m.name_ansm").alias("labo_ansm"), F.col("r.region_code"))
            .agg(F.sum("t.montant").cast("decimal(38,2)").alias("total_cadeaux")))


def _dec(c):
    return F.col(c).cast("decimal(38,6)")


def sales_by_company_region(sales: DataFrame, brand_only: bool = False,
                            brand_flag: str = "0") -> DataFrame:
    """AGG-11/12: total and brand-name sales per (company, region) in one pass;
    with ``brand_only`` only brand-name rows are read and summed."""
    is_brand = F.col("est_generique") == brand_flag
    if brand_only:
        return (sales.where(is_brand).groupBy("labo_ansm", "code_region")
                .agg(F.sum(_dec("total_rembourse")).cast("double").alias("ventes_princeps")))
    return (sales.groupBy("labo_ansm", "code_region")
            .agg(F.sum(_dec("total_rembourse")).cast("double").alias("total_ventes"),
                 F.sum(F.when(is_brand, _dec("total_rembourse")).otherwise(F.lit(0)))
                 .cast("double").alias("ventes_princeps")))


def influence_fact(spend: DataFrame, sales: DataFrame, regions: DataFrame,
                   min_spend: float | None = None, brand_only: bool = False) -> DataFrame:
    """MRT-10: spend joined to sales per (company, region) with the region label.

    Default (current form): total and brand sales, brand share in percent
    (1 decimal) and ROI = brand sales / spend (0 decimals), every pair kept.
    ``brand_only=True, min_spend=1000`` gives the first form: brand sales
    only, pairs without brand sales dropped, spend above the threshold.
    Both sides are aggregated before the join.
    """
    p = sales_by_company_region(sales, brand_only)
    j = (spend.alias("m")
         .join(p.alias("p"), (F.col("m.labo_ansm") == F.col("p.labo_ansm"))
               & (F.col("m.region_code") == F.col("p.code_region")))
         .join(regions.alias("reg"), F.col("m.region_code") == F.col("reg.code")))
    if min_spend is not None:
        j = j.where(F.col("m.total_cadeaux") > F.lit(min_spend))
    roi = round_half_up(safe_div("p.ventes_princeps", "m.total_cadeaux"), 0).alias("roi_influence")
    out = [F.col("m.labo_ansm").alias("labo"), F.col("reg.libelle_reg").alias("region"),
           F.col("m.total_cadeaux"), F.col("p.ventes_princeps")]
    if not brand_only:
        out += [F.col("p.total_ventes"),
                round_half_up(safe_div("p.ventes_princeps", "p.total_ventes") * 100, 1)
                .alias("pct_princeps")]
    return j.select(*out, roi)


def influence_groups(fact: DataFrame, rules=DEFAULT_GROUP_RULES,
                     min_spend: float = 20000) -> DataFrame:
    """MRT-11: roll the fact up to company groups (prefix rules, first match
    wins, else first word after the leading article), keep groups whose
    spend exceeds ``min_spend``. The key is built before upper-casing."""
    g = (fact.groupBy(group_key("labo", rules).alias("groupe"))
         .agg(F.sum("total_cadeaux").cast("decimal(38,2)").alias("total_cadeaux_groupe"),
              F.sum(_dec("ventes_princeps")).cast("double").alias("total_ventes_marques_groupe")))
    return (g.where(F.col("total_cadeaux_groupe") > F.lit(min_spend))
            .select(F.upper("groupe").alias("groupe"), "total_cadeaux_groupe",
                    "total_ventes_marques_groupe",
                    round_half_up(safe_div("total_ventes_marques_groupe", "total_cadeaux_groupe"), 0)
                    .alias("roi_groupe")))


def groups_preview(groups: DataFrame, k: int = 10) -> DataFrame:
    """AGG-15 / TOP-4: the k groups with the best return, numbered in that order."""
    return ranked_top_k(groups, [F.desc_nulls_last("roi_groupe"), F.asc_nulls_last("groupe"),
                                 F.desc("total_cadeaux_groupe")], k)


def top_roi(fact: DataFrame, k: int = 15) -> DataFrame:
    """QRY-4: the k best ROI rows, spend in k€ and brand sales in M€."""
    rows = fact.select("labo", "region",
                       round_half_up(F.col("total_cadeaux") / 1e3, 1).alias("cadeaux_keur"),
                       round_half_up(F.col("ventes_princeps") / 1e6, 1).alias("ventes_meur"),
                       "roi_influence")
    return top_k(rows, [F.desc_nulls_last("roi_influence"), F.asc_nulls_last("labo"),
                        F.asc_nulls_last("region")], k)


def company_focus(fact: DataFrame, patterns: Sequence[str] = ("%SANOFI%", "%PFIZER%"),
                  k: int | None = None) -> DataFrame:
    """QRY-5: average ROI and brand sales (M€) of all companies matching any LIKE
    pattern, best average first; ``rang`` numbers them in that order. With ``k`` the
    best ``k`` only, without a job of its own."""
    cond = None
    for p in patterns:
        c = F.col("labo").like(p)
        cond = c if cond is None else (cond | c)
    focus = (fact.where(cond).groupBy("labo")
             .agg(round_half_up(F.avg("roi_influence"), 0).alias("roi_moyen"),
                  round_half_up(F.sum(_dec("ventes_princeps")) / 1e6, 1).alias("ventes_totales_meur")))
    order = [F.desc_nulls_last("roi_moyen"), F.asc("labo")]
    if k is not None:
        return ranked_top_k(focus, order, k)
    return number_rows(focus, order).withColumn("rang", F.col("rang").cast("int")).orderBy("rang")
