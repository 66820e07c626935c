"""Recipient tables and the postal-code geo reference (MRT-14..16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sunlight.functions import (parse_comma_decimal, postal_code, speciality_label,
                                split_coordinate)
from sunlight.operators import dedup_sum, first_by_order, group_max_lookup
from sunlight.plans.columns import RAW, DeclarationColumns


def geo_ref(points: DataFrame, dept_region: DataFrame, postal_col: str = "Code Postal",
            point_col: str = "geo_point_2d", strict: bool = True) -> DataFrame:
    """MRT-14: one (lat, lon) per postal code, with its region.

    Postal codes are kept as zero-padded text. When a code has several
    points the smallest (lat, lon) is kept - an aggregate with map-side
    combine rather than a sorted window, so a code with millions of points
    costs one row per task before the shuffle.
    """
    pts = (points.where(F.col(f"`{point_col}`").isNotNull())
           .select(postal_code(F.col(f"`{postal_col}`")).alias("cp"),
                   split_coordinate(F.col(f"`{point_col}`"), 1, strict=strict).alias("lat"),
                   split_coordinate(F.col(f"`{point_col}`"), 2, strict=strict).alias("lon")))
    first = first_by_order(pts, ["cp"], ["lat", "lon"])
    return (first.join(dept_region, F.substring("cp", 1, 2) == F.col("dept_code"))
            .select("cp", "lat", "lon", "region_code"))


def _amount(cols: DeclarationColumns):
    return parse_comma_decimal(cols.amount)


def recipient_totals(raw: DataFrame, min_total: float = 500, dedup: bool = True,
                     cols: DeclarationColumns = RAW, clean_rules=None, one_shuffle: bool = False) -> DataFrame:
    """Amount per recipient x payer above ``min_total``, before any lookup.

    With ``dedup`` identical declarations (same recipient, payer, amount and
    date) count once. Profession labels are the raw ones (the staging clean-up
    does not reach this table) unless ``clean_rules`` are given. ``one_shuffle`` is
    that of ``dedup_sum``.
    """
    profession = F.col(cols.profession)
    if clean_rules is not None:
        profession = speciality_label(profession, clean_rules)
    base = raw.where(F.col(cols.amount).isNotNull()).select(
        F.col(cols.name).alias("nom"), F.col(cols.first_name).alias("prenom"),
        F.col(cols.city).alias("ville"), profession.alias("specialite"),
        F.col(cols.company).alias("labo_source"), F.col(cols.amount).alias("_amount"),
        F.col(cols.date).cast("string").alias("_date"))
    keys = ["nom", "prenom", "ville", "specialite", "labo_source"]
    if dedup:
        agg = dedup_sum(base, base.columns, keys, parse_comma_decimal("_amount"), "montant_total", one_shuffle)
    else:
        agg = base.groupBy(*keys).agg(F.sum(parse_comma_decimal("_amount")).alias("montant_total"))
    return (agg.withColumn("montant_total", F.col("montant_total").cast("decimal(38,2)"))
            .where(F.col("montant_total") > F.lit(min_total)))


def with_catalogue_names(totals: DataFrame, name_map: DataFrame) -> DataFrame:
    """The payer's catalogue name(s): one row per matching name, NULL if none."""
    return (totals.alias("a")
            .join(name_map.alias("m"), F.col("a.labo_source") == F.col("m.name_transparence"), "left")
            .select("a.*", F.col("m.name_ansm").alias("labo_normalise")))


def recipients(raw: DataFrame, name_map: DataFrame, declarations_geo: DataFrame,
               min_total: float = 500, dedup: bool = True,
               cols: DeclarationColumns = RAW, clean_rules=None, one_shuffle: bool = False) -> DataFrame:
    """MRT-15: amount received per recipient x payer, above ``min_total``.

    ``recipient_totals`` with the payer's catalogue name(s) and the recipient's
    region: the largest region code among their geo-tagged declarations with the
    same name and city. ``declarations_geo`` is that mart, or any frame with
    (nom, ville, region_code) giving the same maximum, e.g. ``recipient_regions``.
    """
    named = with_catalogue_names(recipient_totals(raw, min_total, dedup, cols, clean_rules, one_shuffle), name_map)
    return group_max_lookup(named, declarations_geo.select("nom", "ville", "region_code"),
                            ["nom", "ville"], "region_code", "region_code")


def recipients_geo(raw: DataFrame, name_map: DataFrame, geo: DataFrame,
                   min_total: float = 500, cols: DeclarationColumns = RAW) -> DataFrame:
    """MRT-16: amount per recipient x payer x postal code (no de-duplication),
    above ``min_total``, with catalogue name(s), region and coordinates of
    the postal code. ``montant_total`` repeats ``montant_cumule`` so that the
    search runs on either recipient table."""
    agg = (raw.where(F.col(cols.amount).isNotNull())
           .groupBy(F.col(cols.name).alias("nom"), F.col(cols.first_name).alias("prenom"),
                    F.col(cols.city).alias("ville"), F.col(cols.profession).alias("specialite"),
                    F.col(cols.company).alias("labo_source"),
                    postal_code(cols.postal_code).alias("cp"))
           .agg(F.sum(_amount(cols)).cast("decimal(38,2)").alias("total_montant"))
           .where(F.col("total_montant") > F.lit(min_total)))
    j = (agg.alias("r")
         .join(name_map.alias("m"), F.col("r.labo_source") == F.col("m.name_transparence"), "left")
         .join(geo.alias("g"), F.col("r.cp") == F.col("g.cp"), "left"))
    return j.select(F.col("r.nom"),
                    F.coalesce(F.nullif(F.col("r.prenom"), F.lit("null")), F.lit("")).alias("prenom"),
                    F.col("r.ville"), F.col("r.specialite"), F.col("r.labo_source"),
                    F.col("m.name_ansm").alias("labo_normalise"), F.col("g.region_code"),
                    F.col("r.total_montant").alias("montant_cumule"),
                    F.col("g.lat").alias("latitude"), F.col("g.lon").alias("longitude"),
                    F.col("r.total_montant").alias("montant_total"))
