"""Physical-plan shape: the properties the design relies on at scale."""

from pyspark.sql import functions as F

from suite.queries import Inputs
from sunlight import plans as P
from sunlight.operators import top_k_per_group

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_mart_never_shuffles_the_fact_for_joins(spark):
    p = plan(Inputs(spark, SF).sales)
    assert "SortMergeJoin" not in p
    assert p.count("BroadcastHashJoin") >= 1


def test_prescriptions_mart_broadcasts_dims(spark):
    i = Inputs(spark, SF)
    p = plan(P.prescriptions_mart(i.rx, i.regions, i.specialities))
    assert "SortMergeJoin" not in p


def test_top_k_per_group_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    p = plan(top_k_per_group(df, ["g"], [F.desc("v")], 3))
    assert "WindowGroupLimit" in p
    # one WindowGroupLimit under the exchange (partial), one above it (final)
    assert p.count("WindowGroupLimit") >= 2


def test_search_is_a_top_k_not_a_sort(spark):
    i = Inputs(spark, SF)
    df = P.search_recipients(i.recipients, i.regions, i.fact(), P.lab_top_products(i.bridge), "00000012")
    assert "GlobalLimit 15" in df._jdf.queryExecution().optimizedPlan().toString()


def test_batch_search_has_no_pairwise_join(spark):
    i = Inputs(spark, SF)
    terms = spark.createDataFrame([("00000012",), ("nation_1",)], "term string")
    df = P.search_recipients_batch(i.recipients, i.regions, i.fact(), P.lab_top_products(i.bridge),
                                   terms)
    p = plan(df)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "WindowGroupLimit" in p


def test_filters_and_columns_reach_the_scan(spark):
    l = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = l.where(F.col("l_returnflag") == "R").select("l_extendedprice")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in p
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in p


def test_no_registered_plan_reads_a_cache(spark):
    """Whatever ran before, a query's plan begins at files."""
    from suite.queries import QUERIES
    for name in ("sales_mart", "agg_money", "recipients_geo"):
        QUERIES[name](spark, SF).count()
    for name in ("landing", "recipients", "search", "dim_labs", "top3_products", "sales_mart", "bridge_trim_join",
                 "geo_ref_first", "fact_influence", "search_batch"):
        assert "InMemoryTableScan" not in plan(QUERIES[name](spark, SF)), name
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_a_written_side_is_broadcast_by_its_size(spark):
    from sunlight.operators import materialise
    side = materialise(spark.range(100).select(F.col("id"), F.lit("x").alias("v")), "side")
    left = spark.range(10_000).select(F.col("id"))
    assert "BroadcastHashJoin" in plan(left.join(side, "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert "BroadcastHashJoin" not in plan(left.join(side, "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dimension_rows_are_marked_only_while_small(spark):
    from sunlight.sources import dim_region
    from sunlight.sources.dims import MARKED_ROWS
    left = spark.range(10).select(F.col("id").cast("string").alias("code"))
    hint = lambda df: "rightHint=(strategy=broadcast)" in left.join(df, "code")._jdf.queryExecution().optimizedPlan().toString()
    assert hint(dim_region(spark))
    assert not hint(dim_region(spark, rows=[(str(i), "x") for i in range(MARKED_ROWS + 1)]))


def test_search_limits_the_lookups_to_the_best_rows(spark):
    """The region lookup and both sides of the fact are semi-joined with the k best rows."""
    from suite.queries import QUERIES
    text = QUERIES["search"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") >= 4


def _nodes(node):
    yield node
    children = node.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _shuffled_records(spark, df) -> list[int]:
    """Records written by each exchange of an executed plan (without re-planning)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        qe = df.select("*")._jdf.queryExecution()               # planned anew, under this setting
        qe.toRdd().count()
        return [n.metrics().apply("shuffleRecordsWritten").value() for n in _nodes(qe.executedPlan())
                if n.nodeName() == "Exchange"]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_asked_departments_are_shuffled(spark):
    """JN-7: of 5,000 declarations 20 ask; the others do not reach the exchange of the department list."""
    from sunlight.sources import dim_dept_region
    raw = spark.range(5000).select(
        F.lit("PFIZER SAS").alias("raison_sociale"), F.concat(F.lit("n"), F.col("id")).alias("identite"), F.lit("p").alias("prenom"),
        F.lit("m").alias("profession_libelle"), F.lit("v").alias("ville"), F.lit("75001").alias("code_postal"), F.lit("10,00").alias("montant"),
        F.lit("2022-01-01").alias("date"), F.when(F.col("id") % 250 == 0, "Frais de transport").otherwise("x").alias("motif_lien_interet"))
    names = spark.createDataFrame([("PFIZER SAS", "PFIZER")], "name_transparence string, name_ansm string")
    stg, depts = P.stg_declarations(raw), dim_dept_region(spark)
    # The same department list with and without the reduction.
    plain = P.influence_spend(stg, names, raw, depts)
    reduced = P.influence_spend(stg, names, raw, depts, reduce_departments=True)
    assert reduced.collect() == plain.collect() != []
    assert max(_shuffled_records(spark, plain)) >= 5000
    assert max(_shuffled_records(spark, reduced)) < 100


def test_bucketed_sides_join_and_aggregate_without_an_exchange(spark):
    from uuid import uuid4
    from sunlight.session import scratch_path
    from sunlight.sinks import write_bucketed
    i = Inputs(spark, SF)
    rx, bridge = (write_bucketed(df, f"t_{uuid4().hex}", scratch_path(spark, "bucketed"), ["cip13"], 4) for df in (i.rx, i.bridge))
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = P.sales_mart(rx, bridge)
        p = plan(df)
        got = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    assert "SortMergeJoin" in p and "Exchange" not in p
    assert got == sorted(map(tuple, P.sales_mart(i.rx, i.bridge).collect()))


def test_sketches_merge_over_loads(spark):
    i = Inputs(spark, SF)
    parts = [P.distinct_sketches(i.rx.where(F.col("top_gen") == g), ["ben_reg"]) for g in ("0", "1")]
    merged = {r["ben_reg"]: r for r in P.merge_sketches(parts[0].unionAll(parts[1]), ["ben_reg"]).collect()}
    exact = i.rx.groupBy("ben_reg").agg(F.countDistinct("pfs_exe_num").alias("a"), F.countDistinct("l_cip13").alias("b")).collect()
    assert len(exact) == len(merged) > 3
    for r in exact:
        assert abs(merged[r["ben_reg"]]["nb_medecins"] - r["a"]) <= max(1, 3 * P.SKETCH_ERROR * r["a"])
        assert abs(merged[r["ben_reg"]]["nb_medicaments"] - r["b"]) <= max(1, 3 * P.SKETCH_ERROR * r["b"])
    assert "Expand" not in plan(P.distinct_sketches(i.rx))
