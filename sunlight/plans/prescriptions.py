"""Reimbursed prescriptions: loading, marts and load checks
(MRT-4, MRT-5, MRT-8, QRY-9, AGG-4..8, AGG-13, AGG-14)."""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sunlight.functions import parse_comma_decimal, parse_fr_number, round_half_up
from sunlight.operators import top_k
from sunlight.plans.columns import RX, PrescriptionColumns
from sunlight.sources.files import read_csv_union_by_name

UNKNOWN_SPECIALITY = "Autre / Inconnu"   # fixed value: label for unmapped codes


def prescriptions_raw(spark: SparkSession, paths: "str | Sequence[str]", sep: str = ";",
                      encoding: str = "UTF-8", **options) -> DataFrame:
    """MRT-4: every yearly file, columns aligned by name, lower-cased.

    ``options`` are those of ``read_csv_union_by_name``: ``multi_line=False`` saves a pass over
    large files without line breaks in fields, ``headers`` the job that reads first lines.
    """
    return read_csv_union_by_name(spark, paths, sep=sep, encoding=encoding, **options)


# A plain decimal number; the cast alone would also take Java's suffixes ('1D', '2f').
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def speciality_key(c: str):
    """Speciality code as INTEGER the lenient way: text such as ' 12 ' or
    '3.7' is read as a number and rounded (12, 4); anything else is NULL."""
    return F.when(F.col(c).rlike(_NUMBER), F.round(F.col(c).try_cast("double")).try_cast("int"))


def prescriptions_mart(rx: DataFrame, regions: DataFrame, specialities: DataFrame,
                       cols: PrescriptionColumns = RX) -> DataFrame:
    """MRT-5: boxes and reimbursed amount per region x speciality x product
    x generic flag, with region / speciality labels (left joins)."""
    j = (rx.alias("r")
         .join(regions.alias("reg"), F.col(f"r.{cols.region}") == F.col("reg.code"), "left")
         .join(specialities.alias("spe"), speciality_key(f"r.{cols.speciality}") == F.col("spe.code"),
               "left"))
    return (j.groupBy(F.col(f"r.{cols.region}").alias("code_region"),
                      F.col("reg.libelle_reg").alias("region"),
                      F.col(f"r.{cols.speciality}").alias("code_spe"),
                      F.coalesce(F.col("spe.libelle"), F.lit(UNKNOWN_SPECIALITY)).alias("specialite"),
                      F.col(f"r.{cols.product}").alias("medicament"),
                      F.col(f"r.{cols.generic_flag}").alias("est_generique"))
            .agg(F.sum(parse_fr_number(f"r.{cols.boxes}")).cast("decimal(38,3)").alias("total_boites"),
                 F.sum(parse_fr_number(f"r.{cols.reimbursed}")).cast("decimal(38,3)")
                 .alias("total_rembourse")))


def _exact_sum_as_double(c) -> "F.Column":
    # Money is summed as an exact decimal and only then turned into DOUBLE,
    # so the total does not depend on the order rows arrive in.
    return F.sum(c).cast("double")


def sales_mart(rx: DataFrame, bridge: DataFrame, cols: PrescriptionColumns = RX,
               number: str = "decimal(18,3)", companies: DataFrame | None = None) -> DataFrame:
    """MRT-8: boxes and reimbursed amount per region x pack x generic flag x
    company, for packs known to the catalogue; DOUBLE totals.

    NULL or blank quantities count as 0. A pack listed several times in the
    bridge is counted once per listing (inner-join semantics). Quantities are
    parsed as ``number`` (a 64-bit decimal by default; sums are wider by
    themselves); give a wider type for more digits.

    The join is left to the planner: with the bridge as a written mart it is
    broadcast below the session's threshold and the prescription fact is not
    shuffled by pack code; beyond, AQE splits a hot pack. The aggregate combines
    map-side. ``companies`` (column ``labo``) keeps only these companies' packs
    and with them only their rows of the fact.
    """
    boxes = parse_fr_number(f"r.{cols.boxes}", to=number, null_as="0")
    paid = parse_fr_number(f"r.{cols.reimbursed}", to=number, null_as="0")
    if companies is not None:
        bridge = bridge.join(companies.select(F.col("labo").alias("labo_ansm")), "labo_ansm", "left_semi")
    j = (rx.alias("r").where(F.col(f"r.{cols.region}").isNotNull())
         .join(bridge.alias("b"), F.col(f"r.{cols.pack}") == F.col("b.cip13")))
    return (j.groupBy(F.col(f"r.{cols.region}").alias("code_region"),
                      F.col(f"r.{cols.pack}").alias("cip13"),
                      F.col(f"r.{cols.generic_flag}").alias("est_generique"),
                      F.col("b.labo_ansm"))
            .agg(_exact_sum_as_double(boxes).alias("total_boites"),
                 _exact_sum_as_double(paid).alias("total_rembourse")))


class PrescriptionChecks(NamedTuple):
    row_count: DataFrame
    distinct_counts: DataFrame
    top_products: DataFrame


def distinct_counts(rx: DataFrame, cols: PrescriptionColumns = RX) -> DataFrame:
    """AGG-5: distinct prescribers and distinct products in one pass."""
    return rx.agg(F.countDistinct(cols.prescriber).alias("nb_medecins"),
                  F.countDistinct(cols.product).alias("nb_medicaments"))


# Sketches of 2**12 registers: a standard error of 1.6 %.
SKETCH_LOG2 = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG2 / 2)


def distinct_sketches(rx: DataFrame, by: Sequence[str] = (), cols: PrescriptionColumns = RX) -> DataFrame:
    """AGG-5 that can be kept and merged: one sketch of the prescribers and one of the products, per ``by``.

    A load adds its own rows of sketches; ``merge_sketches`` counts over any of them without
    the rows behind them. Map-side combined, and a row is not expanded per count.
    """
    return rx.groupBy(*by).agg(F.hll_sketch_agg(cols.prescriber, SKETCH_LOG2).alias("medecins_sketch"),
                               F.hll_sketch_agg(cols.product, SKETCH_LOG2).alias("medicaments_sketch"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct counts over merged sketches, per ``by``."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("medecins_sketch")).alias("nb_medecins"),
                                     F.hll_sketch_estimate(F.hll_union_agg("medicaments_sketch")).alias("nb_medicaments"))


def top_products_by_boxes(rx: DataFrame, k: int = 5, cols: PrescriptionColumns = RX) -> DataFrame:
    """AGG-6: boxes per product (decimal-comma parse to DECIMAL(18,3)), top k."""
    agg = (rx.where(F.col(cols.product).isNotNull())
           .groupBy(F.col(cols.product).alias(cols.product))
           .agg(F.sum(parse_comma_decimal(cols.boxes, 18, 3)).cast("decimal(38,3)").alias("total_boites")))
    return top_k(agg, [F.desc_nulls_last("total_boites"), F.asc(cols.product)], k)


def prescription_checks(rx: DataFrame, k: int = 5, cols: PrescriptionColumns = RX) -> PrescriptionChecks:
    """QRY-9: post-load volume checks (AGG-4, AGG-5, AGG-6)."""
    return PrescriptionChecks(rx.agg(F.count(F.lit(1)).alias("nb_rows")),
                              distinct_counts(rx, cols), top_products_by_boxes(rx, k, cols))


def region_top(mart: DataFrame, k: int = 3) -> DataFrame:
    """AGG-8: reimbursed amount per labelled region, rounded to cents, top k."""
    agg = (mart.where(F.col("region").isNotNull()).groupBy("region")
           .agg(F.round(F.sum("total_rembourse"), 2).cast("decimal(38,2)").alias("total")))
    return top_k(agg, [F.desc_nulls_last("total"), F.asc("region")], k)


def sales_check(sales: DataFrame, k: int = 10) -> DataFrame:
    """AGG-14: sales in millions (1 decimal) and distinct packs per company."""
    agg = (sales.groupBy("labo_ansm")
           .agg(round_half_up(F.sum(F.col("total_rembourse").cast("decimal(38,6)")) / 1e6, 1)
                .alias("ventes_m_eur"),
                F.countDistinct("cip13").alias("nb_medicaments")))
    return top_k(agg, [F.desc_nulls_last("ventes_m_eur"), F.asc_nulls_last("labo_ansm")], k)
