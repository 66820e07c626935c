"""One callable per registered query: (spark, sf_dir) -> DataFrame.

Each one builds its inputs from the star tables (``suite.star``) and runs
the library's builders over the whole tables. Nothing is kept between
queries: small derived sides (catalogue bridge, name map, postal-code
reference) are written and read back anew by each query that joins them, and
that time is the query's own.
"""

from __future__ import annotations

from functools import cached_property, reduce
from typing import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from sunlight import plans as P
from sunlight.session import scratch_path
from sunlight.sinks import (buckets_for, by_partition, export_marts, json_records, ordered_table, first_rows, read_table, replace_table,
                            rewrite_partitions, write_bucketed, write_json, write_observed, write_ordered)
from sunlight.sources import (read_csv_union, read_csv_union_by_name, read_geo_points, read_headerless_tsv,
                              read_tables, read_text_csv, read_tolerant_tsv, register_views)
from sunlight.functions import group_key, parse_comma_decimal, parse_fr_number, to_money_text
from sunlight.operators import (dedup_sum as dedup_sum_op, first_rows_by_position, group_max_lookup, join_fanout,
                                materialise, schema_profile, search_columns, top_k)
from suite import star

# Parameters of the registered queries (chosen inside the data's ranges).
SPECIALITY_RULES = [(("1-URGENT%", "2-high%"), "PRIORITY"), (("3-%",), "MEDIUM")]
GROUP_RULES = [(("LABORATOIRES BRAND#1",), "BRAND ONE-TEENS"),
               (("LABORATOIRES BRAND#2", "LABORATOIRES BRAND#3"), "BRANDS 2-3")]
GROUP_MIN_SPEND = 5_000_000
V1_MIN_SPEND = 2_000_000
RECIPIENT_MIN_TOTAL = 150_000
FOCUS_PATTERNS = ("%#1%", "%#2%")
SEARCH_TERM = "00000012"
LIMIT_TERM = "0000012"           # more than 15 hits
SEARCH_TERMS = ("00000012", "customer#000000077", "nation_1", "0000012", "12", "9")   # the last is too short
MAP_PREVIEW_PREFIXES = ("Brand#1", "Brand#2")

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Inputs and marts of one query, each built once so that a plan referencing
    a mart twice shares one DataFrame (and one analysis). The ``*_mart`` sides are
    written and read back, so that the planner knows their size; so are the
    declarations (``staged``), which the marts behind the name map scan again and again."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        d = star.dims(spark)
        self.depts, self.regions, self.specialities = d["depts"], d["regions"], d["specialities"]

    @cached_property
    def raw(self):
        return star.declarations_raw(self.spark, self.sf_dir)

    @cached_property
    def stg(self):
        return P.stg_declarations(self.raw)

    @cached_property
    def staged(self):
        """The declarations written once, for queries that scan them several times."""
        return materialise(self.raw, "declarations")

    @cached_property
    def staged_stg(self):
        return P.stg_declarations(self.staged)

    @cached_property
    def decl_geo(self):
        return P.declarations_geo(self.stg, self.raw, self.depts)

    @cached_property
    def rx(self):
        return star.prescriptions_raw(self.spark, self.sf_dir)

    @cached_property
    def bridge(self):
        return P.product_bridge(star.catalogue_packs(self.spark, self.sf_dir),
                                star.catalogue_products(self.spark, self.sf_dir))

    @cached_property
    def bridge_mart(self):
        return materialise(self.bridge, "bridge")

    @cached_property
    def name_map(self):
        return P.lab_name_map(self.stg, self.bridge)

    @cached_property
    def map_mart(self):
        return materialise(P.lab_name_map(self.staged_stg, self.bridge_mart), "name-map")

    @cached_property
    def sales(self):
        return P.sales_mart(self.rx, self.bridge_mart)

    @cached_property
    def spend(self):
        return P.influence_spend(self.staged_stg, self.map_mart, self.staged, self.depts)

    def fact(self, **kw):
        return P.influence_fact(self.spend, self.sales, self.regions, **kw)

    @cached_property
    def geo(self):
        return P.geo_ref(star.geo_points_raw(self.spark, self.sf_dir), self.depts)

    @cached_property
    def geo_mart(self):
        return materialise(self.geo, "geo-ref")

    @cached_property
    def recipients(self):
        regions = P.recipient_regions(self.staged_stg, self.staged, self.depts)
        return P.recipients(self.staged, self.map_mart, regions, min_total=RECIPIENT_MIN_TOTAL)


def _q(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


@_q
def fr_decimal_parse(i: Inputs):
    """SCL-1: decimal-comma text -> DECIMAL(18,2), summed per return flag."""
    l = star.table(i.spark, i.sf_dir, "lineitem")
    amount = parse_comma_decimal(to_money_text("l_extendedprice"))
    return l.groupBy("l_returnflag").agg(F.sum(amount).cast("decimal(38,2)").alias("total_amount"),
                                         F.count(F.lit(1)).alias("n_rows"))


@_q
def fr_thousands_parse(i: Inputs):
    """SCL-2: '12.345,50' text -> DECIMAL(18,3), summed per line status."""
    l = star.table(i.spark, i.sf_dir, "lineitem")
    amount = parse_fr_number(to_money_text("l_extendedprice", grouped=True))
    return l.groupBy("l_linestatus").agg(F.sum(amount).cast("decimal(38,3)").alias("total_amount"))


@_q
def top_payers(i: Inputs):
    return P.top_companies(i.stg)


@_q
def top_professions_not_null(i: Inputs):
    return P.top_professions(i.stg)


@_q
def top_motives(i: Inputs):
    return P.top_motives(i.stg)


@_q
def speciality_clean(i: Inputs):
    return P.speciality_summary(P.clean_specialities(i.stg, SPECIALITY_RULES))


@_q
def declarations_geo(i: Inputs):
    return i.decl_geo


@_q
def product_bridge(i: Inputs):
    return i.bridge


@_q
def catalogue_top(i: Inputs):
    return P.catalogue_top(i.bridge)


@_q
def lab_name_map(i: Inputs):
    return i.name_map


@_q
def name_map_preview(i: Inputs):
    m = i.name_map
    cond = None
    for p in MAP_PREVIEW_PREFIXES:
        c = F.col("name_transparence").startswith(p)
        cond = c if cond is None else cond | c
    return top_k(m.where(cond), [F.asc("name_transparence"), F.asc("name_ansm")], 10)


@_q
def prescriptions_mart(i: Inputs):
    return P.prescriptions_mart(i.rx, i.regions, i.specialities)


@_q
def prescription_row_count(i: Inputs):
    return P.prescription_checks(i.rx).row_count


@_q
def prescription_distinct(i: Inputs):
    return P.distinct_counts(i.rx)


@_q
def prescription_top_products(i: Inputs):
    return P.top_products_by_boxes(i.rx)


@_q
def speciality_preview(i: Inputs):
    return top_k(i.rx.select("psp_spe").distinct(), [F.asc_nulls_last("psp_spe")], 10)


@_q
def region_top3(i: Inputs):
    return P.region_top(P.prescriptions_mart(i.rx, i.regions, i.specialities))


@_q
def sales_mart(i: Inputs):
    return i.sales


@_q
def sales_check(i: Inputs):
    return P.sales_check(i.sales)


@_q
def sales_by_lab_region(i: Inputs):
    return P.sales_by_company_region(i.sales)


@_q
def influence_spend(i: Inputs):
    return i.spend


@_q
def influence_fact(i: Inputs):
    return i.fact()


@_q
def influence_fact_v1(i: Inputs):
    return i.fact(min_spend=V1_MIN_SPEND, brand_only=True)


@_q
def influence_groups(i: Inputs):
    return P.influence_groups(i.fact(), GROUP_RULES, min_spend=GROUP_MIN_SPEND)


@_q
def top_roi(i: Inputs):
    return P.top_roi(i.fact())


@_q
def company_focus(i: Inputs):
    return P.company_focus(i.fact(), FOCUS_PATTERNS)


@_q
def lab_dim(i: Inputs):
    return P.lab_dim(i.bridge)


@_q
def lab_top_products(i: Inputs):
    return P.lab_top_products(i.bridge)


@_q
def geo_ref(i: Inputs):
    return i.geo


@_q
def recipients(i: Inputs):
    return i.recipients


@_q
def recipients_geo(i: Inputs):
    return P.recipients_geo(i.staged, i.map_mart, i.geo_mart, min_total=RECIPIENT_MIN_TOTAL)


@_q
def pending_order_max(i: Inputs):
    """JN-14 on its own: largest pending order key per customer, NULL if none."""
    c = star.table(i.spark, i.sf_dir, "customer").select("c_custkey", "c_name")
    o = (star.table(i.spark, i.sf_dir, "orders").where(F.col("o_orderstatus") == "P")
         .select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"))
    return group_max_lookup(c, o, ["c_custkey"], "o_orderkey", "max_pending_order")


@_q
def dedup_sum(i: Inputs):
    """AGG-20 on its own: events de-duplicated on (user, type, value), then
    the value summed per user (exactly, as a decimal)."""
    ev = star.table(i.spark, i.sf_dir, "events")
    return dedup_sum_op(ev, ["user_id", "event_type", "value"], ["user_id"],
                        F.col("value").cast("decimal(18,2)"), "total_value") \
        .withColumn("total_value", F.col("total_value").cast("decimal(38,2)"))


def _search(i: Inputs, term: str) -> DataFrame:
    return P.search_declarations(i.staged, i.map_mart, i.depts, i.regions, i.rx, i.bridge_mart,
                                 P.lab_top_products(i.bridge_mart), term, min_total=RECIPIENT_MIN_TOTAL)


@_q
def search(i: Inputs):
    return _search(i, SEARCH_TERM)


@_q
def search_limit(i: Inputs):
    """QRY-1 with more hits than the limit."""
    return _search(i, LIMIT_TERM)


@_q
def search_mart(i: Inputs):
    """QRY-1 over the recipient and fact marts."""
    return P.search_recipients(i.recipients, i.regions, i.fact(), P.lab_top_products(i.bridge_mart), LIMIT_TERM)


@_q
def search_batch(i: Inputs):
    terms = i.spark.createDataFrame([(t,) for t in SEARCH_TERMS], "term string")
    return P.search_recipients_batch(materialise(i.recipients, "recipients"), i.regions, i.fact(),
                                     P.lab_top_products(i.bridge_mart), terms)


@_q
def search_index(i: Inputs):
    """QRY-1 through the stored index."""
    path = scratch_path(i.spark, "search-index")
    P.build_search_index(i.recipients, path, parts=16, buckets=64)
    return P.search_index(i.spark, path, LIMIT_TERM, i.regions, i.fact(), P.lab_top_products(i.bridge_mart))


@_q
def landing_top(i: Inputs):
    return P.landing_stats(i.recipients).top_groups


@_q
def landing_total(i: Inputs):
    from sunlight.plans.search import GLOBAL_TOTAL_FALLBACK
    return P.landing_stats(i.recipients, fallback=GLOBAL_TOTAL_FALLBACK).total


@_q
def landing_total_fallback(i: Inputs):
    """AGG-23: no amount at all, so the fallback is shown."""
    from sunlight.plans.search import GLOBAL_TOTAL_FALLBACK
    return P.landing_stats(i.recipients.where("montant_total < 0"), fallback=GLOBAL_TOTAL_FALLBACK).total


# --- file round trips: data derived from the tables is written in the awkward
# source formats, then read back with the library's readers --------------------

RAW_COLUMNS = ["raison_sociale", "identite", "prenom", "profession_libelle", "ville",
               "code_postal", "montant", "date", "motif_lien_interet"]
TSV_WIDTH = 11


def write_drifting_csv(i: Inputs) -> str:
    """Declarations as ';' CSV files in two layouts: transport payments with
    upper-case headers in the usual order, all others with the columns
    reversed plus an extra column."""
    base = scratch_path(i.spark, "declarations-csv")
    transport = F.col("motif_lien_interet") == "Frais de transport"
    (i.raw.where(transport).select(*[F.col(c).alias(c.upper()) for c in RAW_COLUMNS])
     .write.option("header", True).option("sep", ";").csv(f"{base}/a"))
    (i.raw.where(~transport).select(*reversed(RAW_COLUMNS), F.lit("x").alias("extra"))
     .write.option("header", True).option("sep", ";").csv(f"{base}/b"))
    return base


@_q
def csv_drift_top_payers(i: Inputs):
    """SRC-2 end to end: drifting-header CSV files -> staging -> top payers."""
    base = write_drifting_csv(i)
    raw = read_csv_union_by_name(i.spark, [f"{base}/a", f"{base}/b"], sep=";", multi_line=False)
    return P.top_companies(P.stg_declarations(raw))


def _tsv_line(*fields):
    return F.concat_ws("\t", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def write_latin1_catalogue(i: Inputs) -> tuple[str, str]:
    """Catalogue exports as Latin-1 TSV: products with 11 fields (company at
    position 10); parts of size 49 get one field too many (to be skipped),
    size 48 only three fields (padded -> no company)."""
    part = star.table(i.spark, i.sf_dir, "part")
    base = scratch_path(i.spark, "catalogue-tsv")
    name = F.concat(F.col("p_name"), F.lit(" é"))
    company = F.concat(F.lit("Laboratoires "), F.col("p_brand"))
    filler = [F.col("p_type"), F.col("p_size"), F.col("p_retailprice"), F.lit("NA"), F.lit("x"),
              F.lit(""), F.lit("y"), F.lit("z")]
    full = _tsv_line(F.col("p_partkey"), name, *filler, company)
    line = (F.when(F.col("p_size") == 49, F.concat(full, F.lit("\textra")))
            .when(F.col("p_size") == 48, _tsv_line(F.col("p_partkey"), name, F.col("p_type")))
            .otherwise(full))
    writer = lambda df, path: (df.write.option("encoding", "ISO-8859-1")
                               .option("quote", "").option("escapeQuotes", False)
                               .option("sep", "\u0001").csv(path))
    writer(part.select(line.alias("line")), f"{base}/products")
    pack = F.concat(F.lit("34"), F.lpad(F.col("p_partkey").cast("string"), 11, "0"))
    packs = part.select(_tsv_line(F.col("p_partkey"), F.lit("a"), F.lit("b"), F.lit("c"),
                                  F.lit("d"), F.lit("e"), pack).alias("line"))
    writer(packs, f"{base}/packs")
    return f"{base}/products", f"{base}/packs"


@_q
def tsv_catalogue_bridge(i: Inputs):
    """SRC-4 end to end: Latin-1 TSV catalogue -> bridge."""
    products_path, packs_path = write_latin1_catalogue(i)
    products = read_tolerant_tsv(i.spark, products_path, {0: "cis", 1: "nom_medicament",
                                                          10: "labo_ansm"}, width=TSV_WIDTH)
    packs = read_tolerant_tsv(i.spark, packs_path, {0: "cis", 6: "cip13"}, width=7)
    return P.product_bridge(packs, products)


@_q
def landing_label(i: Inputs):
    """SCL-20: the headline amount label of the landing figures."""
    return P.landing_labels(P.landing_stats(i.recipients).total)


@_q
def landing_payers(i: Inputs):
    """SCL-20: the amount labels of the top payers."""
    return P.payer_labels(P.landing_stats(i.recipients).top_groups)


@_q
def search_report(i: Inputs):
    """SCL-21: display fields and sentences of the search results."""
    return P.recipient_report(_search(i, SEARCH_TERM))


AWKWARD = ('he said "yes" to ', "ends in a backslash \\", "two\nlines of ", "a;b and c,d of ", '"quoted whole"', "plain ")


@_q
def csv_quoted_roundtrip(i: Inputs):
    """SRC-1: quotes, backslashes, separators and line breaks survive a CSV file."""
    part = star.table(i.spark, i.sf_dir, "part")
    note = F.element_at(F.array(*[F.lit(x) for x in AWKWARD]), (F.col("p_partkey") % 6 + 1).cast("int"))
    text = F.when(F.col("p_partkey") % 6 == 1, F.concat("p_name", note)).otherwise(F.concat(note, "p_name"))
    base = scratch_path(i.spark, "quoted-csv")
    (part.select(F.col("p_partkey").cast("string").alias("id"), text.alias("note"), "p_brand")
     .write.option("header", True).option("sep", ";").option("escape", '"').csv(base))
    return read_text_csv(i.spark, base, sep=";").select(F.col("id").cast("bigint").alias("id"), "note", "p_brand")


@_q
def csv_rejected_rows(i: Inputs):
    """SRC-2: records that do not fit their header are set apart, and counted."""
    c = star.table(i.spark, i.sf_dir, "customer")
    fields = F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")
    line = (F.when(F.col("c_custkey") % 10 == 0, F.concat(fields, F.lit(";extra")))
            .when(F.col("c_custkey") % 10 == 1, F.concat_ws(";", F.col("c_custkey").cast("string"), "c_name"))
            .otherwise(fields))
    base = scratch_path(i.spark, "rejects-csv")
    (c.select(line.alias("ID;NAME;SEGMENT")).write.option("header", True).option("quote", "")
     .option("escapeQuotes", False).option("sep", "\u0001").csv(base))
    read = read_csv_union(i.spark, base, sep=";")
    kept = read.rows.groupBy("segment").agg(F.count(F.lit(1)).alias("n_rows"),
                                            F.sum(F.col("id").cast("bigint")).alias("sum_id"))
    lost = read.rejected.agg(F.lit("rejected").alias("segment"), F.count(F.lit(1)).alias("n_rows"),
                             F.sum(F.split_part("record", F.lit(";"), F.lit(1)).cast("bigint")).alias("sum_id"))
    return kept.unionByName(lost)


RX_COLUMNS = ["ben_reg", "psp_spe", "cip13", "l_cip13", "top_gen", "boites", "rem", "pfs_exe_num"]


@_q
def rx_csv_union_mart(i: Inputs):
    """MRT-4 -> MRT-5: yearly prescription files in two layouts through the loader into the mart."""
    base = scratch_path(i.spark, "rx-csv")
    first = F.col("cip13") < F.lit("3400000000900")
    (i.rx.where(first).select(*[F.col(c).alias(c.upper()) for c in RX_COLUMNS])
     .write.option("header", True).option("sep", ";").csv(f"{base}/y1"))
    (i.rx.where(~first).select(F.lit("2023").alias("annee"), *reversed(RX_COLUMNS))
     .write.option("header", True).option("sep", ";").csv(f"{base}/y2"))
    rx = P.prescriptions_raw(i.spark, [f"{base}/y1", f"{base}/y2"], whole_file_bytes=0)
    return P.prescriptions_mart(rx, i.regions, i.specialities)


@_q
def csv_split_records(i: Inputs):
    """SRC-1, MRT-4: quoted fields with line breaks, separators and doubled quotes in files read by splits."""
    l = star.table(i.spark, i.sf_dir, "lineitem")
    pick = (F.col("l_partkey") + F.col("l_linenumber")) % len(AWKWARD) + 1
    note = F.concat(F.element_at(F.array(*[F.lit(x) for x in AWKWARD]), pick.cast("int")), "l_returnflag")
    base = scratch_path(i.spark, "split-csv")
    (l.select(F.col("l_suppkey").cast("string").alias("supplier"), note.alias("note"), to_money_text("l_quantity").alias("quantity"))
     .write.option("header", True).option("sep", ";").option("escape", '"').csv(base))
    rows = read_text_csv(i.spark, base, sep=";", whole_file_bytes=0)
    return rows.groupBy("note").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("supplier").cast("bigint")).alias("suppliers"),
        F.sum(parse_comma_decimal("quantity")).cast("decimal(38,2)").alias("quantity"))


@_q
def speciality_codes(i: Inputs):
    """T7: codes with suffixes, blanks and decimals as specialities."""
    codes = ("1D", "2f", " 12 ", "3.7", "", "x", "15")
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("pfs_exe_num").cast("int") % 7 + 1))
    mart = P.prescriptions_mart(i.rx.withColumn("psp_spe", code), i.regions, i.specialities)
    return mart.groupBy("code_spe", "specialite").agg(F.sum("total_boites").cast("decimal(38,3)").alias("boites"))


@_q
def strict_tsv_packs(i: Inputs):
    """SRC-3: the strict headerless scan of the pack export."""
    _, packs = write_latin1_catalogue(i)
    return read_headerless_tsv(i.spark, packs, {0: "cis", 6: "cip13"}, encoding="ISO-8859-1")


@_q
def geo_points_file(i: Inputs):
    """SRC-5 -> MRT-14: the points as a file, then the postal-code reference."""
    base = scratch_path(i.spark, "geo-points")
    star.geo_points_raw(i.spark, i.sf_dir).write.option("header", True).option("sep", ";").csv(base)
    return P.geo_ref(read_geo_points(i.spark, base), i.depts)


@_q
def quoted_catalogue_bridge(i: Inputs):
    """SRC-4: quoted fields, and each file's width from its first line."""
    part = star.table(i.spark, i.sf_dir, "part")
    base = scratch_path(i.spark, "catalogue-quoted")
    name = F.concat(F.lit('"'), "p_name", F.lit("\t"), F.lit('""fort"""'))
    company = F.concat(F.lit('"Laboratoires ""'), "p_brand", F.lit('"""'))
    filler = [F.lit(x) for x in ("a", "b", "NA", "c", "", "d", "e", "f")]
    full = _tsv_line(F.col("p_partkey"), name, *filler, company)
    kind = F.when(F.col("p_size") == 49, 1).when(F.col("p_size") == 48, 2).otherwise(0)
    line = (F.when(kind == 1, F.concat(full, F.lit('\t"extra\tfield"')))
            .when(kind == 2, _tsv_line(F.col("p_partkey"), name, F.lit("a"))).otherwise(full))
    (part.select(line.alias("line"), kind.alias("kind")).repartition(4).sortWithinPartitions("kind").select("line")
     .write.option("encoding", "ISO-8859-1").option("quote", "").option("escapeQuotes", False)
     .option("sep", "\u0001").csv(f"{base}/products"))
    packs = part.select(_tsv_line(F.col("p_partkey"), *[F.lit(x) for x in "abcde"], star.pack_code("p_partkey")).alias("line"))
    (packs.write.option("encoding", "ISO-8859-1").option("quote", "").option("escapeQuotes", False)
     .option("sep", "\u0001").csv(f"{base}/packs"))
    products, packs = P.load_catalogue(i.spark, f"{base}/products", f"{base}/packs")
    return P.product_bridge(packs, products)


@_q
def view_segment_revenue(i: Inputs):
    """SRC-6, SRC-9: several tables at once, as views for SQL."""
    tables = read_tables(i.spark, i.sf_dir, ("customer", "orders", "nation"))
    register_views({f"sun_{n}": df for n, df in tables.items()})
    return i.spark.sql("""
        SELECT n.n_name, c.c_mktsegment, count(*) AS n_orders,
               CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS DECIMAL(38, 2)) AS revenue
        FROM sun_orders o JOIN sun_customer c ON o.o_custkey = c.c_custkey
        JOIN sun_nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_name, c.c_mktsegment""")


@_q
def marts_export_roundtrip(i: Inputs):
    """SNK-1..3: marts exported and read back by name."""
    bridge = i.bridge_mart
    paths = export_marts({"companies": P.lab_dim(bridge), "products": P.lab_top_products(bridge)},
                         scratch_path(i.spark, "export"))
    companies, products = (i.spark.read.parquet(paths[n]) for n in ("companies", "products"))
    return companies.join(products, companies.labo_id == products.labo_ansm, "left").drop("labo_ansm")


@_q
def json_records_parsed(i: Inputs):
    """SNK-4: JSON records, parsed back."""
    return json_records(i.bridge).select(F.from_json("json", i.bridge.schema).alias("r")).select("r.*")


@_q
def json_file_roundtrip(i: Inputs):
    """SNK-4: a JSON file, read back."""
    dim = P.lab_dim(i.bridge)
    return i.spark.read.schema(dim.schema).json(write_json(dim, scratch_path(i.spark, "json")))


@_q
def column_probe(i: Inputs):
    """PRJ-6..8: the first rows of the fact by position, for columns found by name."""
    l = star.table(i.spark, i.sf_dir, "lineitem")
    head = first_rows_by_position(l, 20, [F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    found = search_columns(schema_profile(i.spark, l), ("key", "flag", "status", "number"))
    return head.join(F.broadcast(found), "position").select("row", "position", "name", "type", "value")


@_q
def fanout_report(i: Inputs):
    """T11: rows and amounts before and after the name-map join."""
    stg, m = i.staged_stg, i.map_mart
    return join_fanout(stg, m, stg["labo"] == m["name_transparence"], "montant").withColumns(
        {c: F.col(c).cast("decimal(38,2)") for c in ("amount_before", "amount_after")})


@_q
def group_preview(i: Inputs):
    """AGG-15, TOP-4/5: the best groups, numbered in order."""
    return P.groups_preview(P.influence_groups(i.fact(), GROUP_RULES, min_spend=0))


NAMES_BY_SIZE = ("SANOFI PASTEUR", "OPELLA SANTE", "PFIZER", "NOVARTIS PHARMA", "BAYER", "MERCK SERONO",
                 "SERVIER MONDE", "LES LABORATOIRES SERVIER", "BIOGARAN", "BOEHRINGER", "ASTRAZENECA", "VIATRIS",
                 "LES AUTRES", "Laboratoires Théa", "Sanofi")


@_q
def group_default_rules(i: Inputs):
    """SCL-12: the ten default rules, and the first word of other names."""
    part = star.table(i.spark, i.sf_dir, "part")
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES_BY_SIZE]), F.col("p_size") % len(NAMES_BY_SIZE) + 1)
    return part.groupBy(group_key(name).alias("groupe")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))


@_q
def table_replaced_from_itself(i: Inputs):
    """SNK-1: a stored table replaced by a job that reads it; the version before stays readable."""
    path = scratch_path(i.spark, "replaced")
    part = star.table(i.spark, i.sf_dir, "part").select("p_partkey", "p_name", "p_size", F.lit(1).alias("revision"))
    replace_table(part, path)
    old = read_table(i.spark, path)
    replace_table(old.where("p_size % 5 <> 0").withColumn("p_name", F.upper("p_name")).withColumn("revision", F.lit(2)), path)
    now = read_table(i.spark, path)
    return now.unionByName(old.where("p_size % 5 = 0"))


MART_COUNTED = ("stg_declarations", "stg_declarations_clean", "declarations_geo", "product_bridge", "lab_name_map",
                "prescriptions_mart", "sales_mart", "influence_spend", "influence_fact", "lab_dim", "lab_top_products",
                "geo_ref", "declarations_raw", "prescriptions_raw", "recipients", "recipients_geo")


@_q
def mart_build(i: Inputs):
    """MRT-17: every mart built once, with the rows observed while writing and those of the table."""
    marts = P.build_marts(i.spark, scratch_path(i.spark, "all-marts"), i.raw, i.rx,
                          star.catalogue_products(i.spark, i.sf_dir), star.catalogue_packs(i.spark, i.sf_dir),
                          i.depts, i.regions, i.specialities, geo_points=star.geo_points_raw(i.spark, i.sf_dir),
                          min_total=RECIPIENT_MIN_TOTAL)
    seen = i.spark.createDataFrame([(n, marts.metrics[n]["rows"]) for n in MART_COUNTED], "mart string, n_observed long")
    stored = [i.spark.read.parquet(marts[n]).agg(F.lit(n).alias("mart"), F.count(F.lit(1)).alias("n_stored")) for n in MART_COUNTED]
    return seen.join(reduce(lambda a, b: a.unionAll(b), stored), "mart")


@_q
def load_totals(i: Inputs):
    """AGG-4, SNK-3: rows, rejected amounts and sums as by-products of a write."""
    amount = parse_fr_number("rem")
    seen = write_observed(i.rx, scratch_path(i.spark, "load"), metrics={
        "n_rows": F.count(F.lit(1)), "n_without_region": F.count_if(F.col("ben_reg").isNull()),
        "reimbursed": F.sum(amount).cast("decimal(38,3)")}).metrics
    return i.spark.createDataFrame([(seen["n_rows"], seen["n_without_region"], seen["reimbursed"])],
                                   "n_rows long, n_without_region long, reimbursed decimal(38,3)")


def _payment_order():
    return [F.desc("total"), F.asc("o_custkey")]


@_q
def ordered_table_places(i: Inputs):
    """TOP-4: a table stored in order, read back with each row's place."""
    totals = star.table(i.spark, i.sf_dir, "orders").groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total"))
    path = scratch_path(i.spark, "ordered")
    write_ordered(totals, path, _payment_order(), partitions=8)
    return ordered_table(i.spark, path, "place")


@_q
def ordered_table_first(i: Inputs):
    """TOP-4: the first rows of a stored order, from the first folders alone."""
    orders = star.table(i.spark, i.sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    path = scratch_path(i.spark, "ordered-first")
    write_ordered(orders, path, [F.desc("price"), F.asc("o_orderkey")], partitions=16)
    return first_rows(i.spark, path, 500, "place")


@_q
def entity_clean_in_place(i: Inputs):
    """PRJ-9: the ordered conditional rewrite, in the stored partitions that hold a matching label."""
    path = scratch_path(i.spark, "in-place")
    stg = i.stg.withColumn("status", F.substring("date", 1, 4))
    by_partition(stg, "status").write.partitionBy("status").parquet(path)
    label = F.when(F.col("specialite").like("1-%"), "PRIORITY").otherwise(F.col("specialite"))
    rewrite_partitions(i.spark, path, "status", {"specialite": label}, F.col("status").isin("1995", "1996") & F.col("specialite").like("1-%"))
    return i.spark.read.parquet(path).groupBy("specialite", F.col("status").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


@_q
def agg_money_reduced(i: Inputs):
    """JN-7, MRT-9: the department side reduced to the asking (name, date) pairs before it is shuffled."""
    return P.influence_spend(i.staged_stg, i.map_mart, i.staged, i.depts, reduce_departments=True)


@_q
def sales_mart_bucketed(i: Inputs):
    """JN-10, AGG-13: prescriptions and catalogue bridge stored in buckets of the pack code."""
    buckets = buckets_for(i.rx, i.bridge)
    rx, bridge = (write_bucketed(df, f"sun_{kind}_{uuid4().hex}", scratch_path(i.spark, f"bucketed-{kind}"), ["cip13"], buckets)
                  for kind, df in (("rx", i.rx), ("bridge", i.bridge)))
    return P.sales_mart(rx, bridge)


@_q
def distinct_merged(i: Inputs):
    """AGG-5: sketches of two loads, merged, against the exact counts."""
    loads = [P.distinct_sketches(i.rx.where(F.col("top_gen") == flag)) for flag in ("0", "1")]
    merged = P.merge_sketches(loads[0].unionAll(loads[1]))
    exact = P.distinct_counts(i.rx).withColumn("e", merged.select(F.struct(*merged.columns)).scalar())
    near = lambda n: F.abs(F.col(f"e.{n}") - F.col(n)) <= F.greatest(F.lit(1.0), F.col(n) * 3 * P.SKETCH_ERROR)
    return exact.select("nb_medecins", "nb_medicaments", near("nb_medecins").alias("medecins_close"),
                        near("nb_medicaments").alias("medicaments_close"))


QUERIES: dict[str, Query] = {
    fn.__name__: fn for fn in [
        fr_decimal_parse, fr_thousands_parse, top_payers, top_professions_not_null,
        top_motives, speciality_clean, declarations_geo, product_bridge, catalogue_top,
        lab_name_map, name_map_preview, prescriptions_mart, prescription_row_count,
        prescription_distinct, prescription_top_products, speciality_preview, region_top3,
        sales_mart, sales_check, sales_by_lab_region, influence_spend, influence_fact,
        influence_fact_v1, influence_groups, top_roi, company_focus, lab_dim,
        lab_top_products, geo_ref, recipients, recipients_geo, pending_order_max, search,
        search_batch, landing_top, landing_total, csv_drift_top_payers,
        tsv_catalogue_bridge, landing_label, search_report, dedup_sum, search_limit, search_mart,
        landing_payers, csv_quoted_roundtrip, csv_rejected_rows, rx_csv_union_mart, speciality_codes,
        strict_tsv_packs, geo_points_file, quoted_catalogue_bridge, view_segment_revenue,
        marts_export_roundtrip, json_records_parsed, json_file_roundtrip, column_probe, fanout_report,
        group_preview, group_default_rules, csv_split_records,
        search_index, table_replaced_from_itself, mart_build, load_totals, ordered_table_places,
        ordered_table_first, entity_clean_in_place, agg_money_reduced, sales_mart_bucketed, distinct_merged,
        landing_total_fallback,
    ]
}

SURVEY_NAMES = {
    "prescription_distinct": "multi_distinct",
    "declarations_geo": "geo_bridge_left",
    "product_bridge": "bridge_trim_join",
    "influence_spend": "agg_money",
    "influence_fact": "fact_influence",
    "influence_fact_v1": "fact_influence_threshold",
    "influence_groups": "group_consolidation",
    "speciality_clean": "entity_clean",
    "lab_dim": "dim_labs",
    "lab_top_products": "top3_products",
    "pending_order_max": "corr_max",
    "geo_ref": "geo_ref_first",
    "landing_top": "landing",
    "company_focus": "focus_avg",
    "top_roi": "roi_top15",
}
QUERIES = {SURVEY_NAMES.get(name, name): fn for name, fn in QUERIES.items()}
