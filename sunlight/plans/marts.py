"""Build every mart once, in dependency order (MRT-17 and the DAG of

Each mart is written as Parquet under ``out_dir`` and read back for the
marts that depend on it, which is how the source's sequence of
create-table scripts maps onto Spark: shared intermediates are computed
once, lineage is cut at every table (a lost executor recomputes at most one
step), and downstream steps start from compact Parquet.
"""

from __future__ import annotations

import os
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sunlight.plans import catalogue as CAT
from sunlight.plans import declarations as DEC
from sunlight.plans import influence as INF
from sunlight.plans import prescriptions as RXP
from sunlight.plans.recipients import geo_ref, recipients, recipients_geo
from sunlight.plans.columns import RAW, RX, DeclarationColumns, PrescriptionColumns
from sunlight.sinks import row_count, swap_table


class Marts(dict):
    """Paths by mart, and what was observed while each was written (``metrics``: rows, sums)."""

    def __init__(self):
        super().__init__()
        self.metrics: dict[str, dict] = {}


def _exact(c: str) -> Column:
    return F.sum(F.col(c).cast("decimal(38,6)"))


# Totals of a mart besides its rows, observed on the way.
OBSERVED = {
    "stg_declarations": {"amount": ("montant", _exact)},
    "sales_mart": {"reimbursed": ("total_rembourse", _exact)},
    "influence_spend": {"spend": ("total_cadeaux", _exact)},
    "recipients": {"amount": ("montant_total", _exact)},
}


def build_marts(spark: SparkSession, out_dir: str, declarations_raw: DataFrame,
                prescriptions_raw: DataFrame, products: DataFrame, packs: DataFrame,
                dept_region: DataFrame, regions: DataFrame, specialities: DataFrame,
                geo_points: DataFrame | None = None, min_total: float = 500,
                decl_cols: DeclarationColumns = RAW, rx_cols: PrescriptionColumns = RX,
                stage_inputs: bool = True) -> Marts:
    """Write all marts; return ``{name: path}``, with rows and totals of each in ``metrics``.

    The figures are by-products of the writes (no table is scanned again to count it), and
    each table is replaced only once its new form is complete.

    With ``stage_inputs`` the two raw inputs are first written as Parquet:
    the declarations feed five marts and the prescriptions two, so the
    (CSV) parsing happens once and every later scan reads only the columns
    it needs. The profession clean-up is a mart of its own
    (``stg_declarations_clean``); other marts read the labels as declared.
    """
    paths = Marts()

    def put(name: str, df: DataFrame) -> DataFrame:
        totals = {k: f(c) for k, (c, f) in OBSERVED.get(name, {}).items()}
        paths[name], paths.metrics[name] = swap_table(df, os.path.join(out_dir, name), metrics={**row_count(), **totals})
        return spark.read.parquet(paths[name])

    if stage_inputs:
        declarations_raw = put("declarations_raw", declarations_raw)
        prescriptions_raw = put("prescriptions_raw", prescriptions_raw)

    stg = put("stg_declarations", DEC.stg_declarations(declarations_raw, decl_cols))
    put("stg_declarations_clean", DEC.clean_specialities(stg))
    geo = put("declarations_geo", DEC.declarations_geo(stg, declarations_raw, dept_region,
                                                       decl_cols))
    bridge = put("product_bridge", CAT.product_bridge(packs, products))
    name_map = put("lab_name_map", INF.lab_name_map(stg, bridge))
    put("prescriptions_mart", RXP.prescriptions_mart(prescriptions_raw, regions, specialities,
                                                     rx_cols))
    sales = put("sales_mart", RXP.sales_mart(prescriptions_raw, bridge, rx_cols))
    # The geo mart holds the payments with their regions; only a department listed without a region cannot be told there.
    located = geo if dept_region.where(F.col("region_code").isNull()).isEmpty() else None
    spend = put("influence_spend", INF.influence_spend(stg, name_map, declarations_raw, dept_region, cols=decl_cols,
                                                       reduce_departments=True, located=located))
    fact = put("influence_fact", INF.influence_fact(spend, sales, regions))
    put("influence_groups", INF.influence_groups(fact))
    put("lab_dim", CAT.lab_dim(bridge))
    put("lab_top_products", CAT.lab_top_products(bridge))
    put("regions", regions)
    put("recipients", recipients(declarations_raw, name_map, geo, min_total=min_total,
                                     cols=decl_cols, one_shuffle=True))
    if geo_points is not None:
        ref = put("geo_ref", geo_ref(geo_points, dept_region))
        put("recipients_geo", recipients_geo(declarations_raw, name_map, ref,
                                                 min_total=min_total, cols=decl_cols))
    return paths
