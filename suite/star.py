"""Domain inputs derived from the star-schema tables.

Role mapping (one payment / one prescription line per ``lineitem`` row):

=====================  =====================================================
payment declaration    lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part
  payer company        ``p_brand || ' SAS'``
  recipient / first    ``c_name`` / ``c_mktsegment``
  profession           ``o_orderpriority`` ('5-LOW' -> NULL)
  city                 ``n_name``
  postal code          ``c_nationkey * 1000 + c_custkey % 1000`` as text
                       (department = nation key, zero-padded)
  amount               ``l_extendedprice`` written '68423,46'; NULL when
                       ``l_discount = 0`` (declarations without amount)
  date                 ``o_orderdate`` as 'YYYY-MM-DD'
  motive               ``o_orderstatus``: F/O/P -> transport / meal / other
prescription line      lineitem ⋈ orders ⋈ customer ⋈ part ⟕ dept->region
  region               region of the customer's department (NULL if none)
  speciality code      ``l_linenumber * 2.5`` as text ('2.5', '5.0', ...)
  pack / product       '34' + 11-digit ``l_partkey`` / ``p_name``
  generic flag         '0' (brand) when ``l_linestatus = 'O'`` else '1'
  boxes / reimbursed   ``l_quantity`` / ``l_extendedprice`` in the
                       '12.345,50' dialect
  prescriber           ``l_suppkey``
catalogue              ``part``: products (padded id, name, company
                       'Laboratoires ' || p_brand, NULL when p_size = 50);
                       packs (padded id, pack code, '' when p_size = 1)
postal-code points     ``customer``: code as above, "lat, lon" from
                       ``c_acctbal`` / ``c_custkey`` (NULL when c_acctbal < 0)
departments / regions  the library's fixed reference dimensions
=====================  =====================================================
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, functions as F

from sunlight.functions import to_money_text
from sunlight.sources import dim_dept_region, dim_region, dim_speciality, spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


_TABLE_CACHE: dict = {}
# The test files store each table as one row group, so one task; the largest is
# spread. (On the test files the planner broadcasts orders by its size; a large
# orders table is shuffled like any other.)
SPREAD_TABLES = {"lineitem": ("l_orderkey",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table, resolved once per session (file listing and footer
    reads are not repeated for every query)."""
    key = (id(spark), sf_dir, name)
    df = _TABLE_CACHE.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name in SPREAD_TABLES:
            df = spread(df, keys=SPREAD_TABLES[name])
        _TABLE_CACHE[key] = df
    return df


def _motive():
    return (F.when(F.col("o_orderstatus") == "F", F.lit("Frais de transport"))
            .when(F.col("o_orderstatus") == "O", F.lit("Hospitalité - restauration"))
            .otherwise(F.lit("Autre motif")))


def _postal_code():
    return (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000).cast("string")


def declarations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    p = table(spark, sf_dir, "part")
    # Customers join the orders before the lines do, and parts the bare lines: a line is
    # shuffled twice, narrow both times, and a filter on recipients limits the orders first.
    buyers = o.join(c.join(n, c.c_nationkey == n.n_nationkey), o.o_custkey == c.c_custkey)
    j = l.join(p, l.l_partkey == p.p_partkey).join(buyers, l.l_orderkey == o.o_orderkey)
    return j.select(
        F.concat(F.col("p_brand"), F.lit(" SAS")).alias("raison_sociale"),
        F.col("c_name").alias("identite"),
        F.col("c_mktsegment").alias("prenom"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("profession_libelle"),
        F.col("n_name").alias("ville"),
        _postal_code().alias("code_postal"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string"))
         .otherwise(to_money_text("l_extendedprice")).alias("montant"),
        F.col("o_orderdate").cast("date").cast("string").alias("date"),
        _motive().alias("motif_lien_interet"))


def prescriptions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    p = table(spark, sf_dir, "part")
    d = dims(spark)["depts"]
    regions = c.join(d, F.lpad(F.col("c_nationkey").cast("string"), 2, "0") == d.dept_code, "left")
    buyers = o.join(regions, o.o_custkey == c.c_custkey).select("o_orderkey", "region_code")
    # Orders first here: a filter on the region drops lines before they meet the parts.
    j = l.join(buyers, l.l_orderkey == F.col("o_orderkey")).join(p, l.l_partkey == p.p_partkey)
    return j.select(
        F.col("region_code").alias("ben_reg"),
        (F.col("l_linenumber") * 2.5).cast("decimal(4,1)").cast("string").alias("psp_spe"),
        pack_code("l_partkey").alias("cip13"),
        F.col("p_name").alias("l_cip13"),
        F.when(F.col("l_linestatus") == "O", F.lit("0")).otherwise(F.lit("1")).alias("top_gen"),
        to_money_text("l_quantity", grouped=True).alias("boites"),
        to_money_text("l_extendedprice", grouped=True).alias("rem"),
        F.col("l_suppkey").cast("string").alias("pfs_exe_num"))


def pack_code(c: str):
    return F.concat(F.lit("34"), F.lpad(F.col(c).cast("string"), 11, "0"))


def catalogue_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.col("p_partkey").cast("string"), F.lit(" ")).alias("cis"),
        F.concat(F.lit(" "), F.col("p_name")).alias("nom_medicament"),
        F.when(F.col("p_size") == 50, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Laboratoires "), F.col("p_brand"))).alias("labo_ansm"))


def catalogue_packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string")).alias("cis"),
        F.when(F.col("p_size") == 1, F.lit("")).otherwise(pack_code("p_partkey")).alias("cip13"))


def geo_points_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    point = F.concat((F.col("c_acctbal") / 100).cast("decimal(12,4)").cast("string"), F.lit(", "),
                     (F.col("c_custkey") / 1000).cast("decimal(12,4)").cast("string"))
    return c.select(_postal_code().alias("Code Postal"),
                    F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
                     .otherwise(point).alias("geo_point_2d"))


_DIM_CACHE: dict = {}


def dims(spark: SparkSession) -> dict[str, DataFrame]:
    d = _DIM_CACHE.get(id(spark))
    if d is None or d["depts"].sparkSession is not spark:
        d = _DIM_CACHE[id(spark)] = {"depts": dim_dept_region(spark), "regions": dim_region(spark),
                                     "specialities": dim_speciality(spark)}
    return d
