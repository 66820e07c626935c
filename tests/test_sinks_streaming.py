import json
import os

from pyspark.sql import functions as F

from conftest import rows
from sunlight.session import scratch_path
from sunlight.sinks import export_marts, json_records, write_json
from sunlight.streaming import start_staging_stream
from sunlight.operators import schema_profile, search_columns, find_columns, first_rows_by_position
import fixture_c as C


def test_export_marts_round_trip(spark, fx):
    out = scratch_path(spark, "export")
    paths = export_marts({"regions": fx["regions"], "depts": fx["depts"]}, out)
    back = spark.read.parquet(paths["regions"])
    assert rows(back) == rows(fx["regions"])
    assert spark.read.parquet(paths["depts"]).count() == fx["depts"].count()


def test_json_records(spark, fx):
    recs = [json.loads(r["json"]) for r in json_records(fx["regions"]).collect()]
    assert {"code": "94", "libelle_reg": "Corse"} in recs


def test_staging_stream_is_incremental(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    header = ",".join(C.RAW_COLS)

    def put(name, recs):
        lines = [header] + [",".join("" if v is None else f'"{v}"' for v in r) for r in recs]
        (src / name).write_text("\n".join(lines) + "\n", encoding="utf-8")

    put("a.csv", C.DECLARATIONS[:4])
    out = scratch_path(spark, "stg")
    q = start_staging_stream(spark, str(src), out, C.RAW_COLS)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 4
    put("b.csv", C.DECLARATIONS[4:])
    q = start_staging_stream(spark, str(src), out, C.RAW_COLS)
    q.awaitTermination(120)
    df = spark.read.parquet(out)
    assert df.count() == 7            # the NULL-amount row is dropped, nothing duplicated
    assert df.agg(F.sum("montant")).first()[0] == sum(
        __import__("decimal").Decimal(r[6].replace(",", ".")) for r in C.DECLARATIONS if r[6])


def test_stream_reads_what_the_batch_reader_reads(spark, tmp_path):
    """Quotes, doubled quotes, line breaks and rejected records, as in a batch."""
    from sunlight.plans import stg_declarations
    from sunlight.sources import read_csv_union
    from sunlight.streaming import start_rejected_stream
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(",".join(C.RAW_COLS) + "\n"
                               + '"Lab ""X"", SAS",DUPONT,A,Médecin,PARIS,75001,"12,50",2022-01-01,Repas\n'
                               + '"two\nlines",DURAND,B,\\,LYON,69001,"7,25",2022-01-02,Repas\n'
                               + 'too,few,fields\n', encoding="utf-8")
    out, bad = scratch_path(spark, "stg"), scratch_path(spark, "bad")
    start_staging_stream(spark, str(src), out, C.RAW_COLS).awaitTermination(120)
    start_rejected_stream(spark, str(src), bad, C.RAW_COLS).awaitTermination(120)
    batch = read_csv_union(spark, str(src), sep=",", lower=False)
    assert rows(spark.read.parquet(out)) == rows(stg_declarations(batch.rows))
    assert {(r["labo"], str(r["montant"])) for r in spark.read.parquet(out).collect()} == {('Lab "X", SAS', "12.50"), ("two\nlines", "7.25")}
    assert [r["record"] for r in spark.read.parquet(bad).collect()] == [r["record"] for r in batch.rejected.collect()]


def test_stream_refuses_another_header(spark, tmp_path):
    import pytest
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(",".join(reversed(C.RAW_COLS)) + "\n" + ",".join("x" * 9) + "\n", encoding="utf-8")
    out = scratch_path(spark, "stg")
    q = start_staging_stream(spark, str(src), out, C.RAW_COLS)
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        q.awaitTermination(120)
    assert not [f for f in os.listdir(out.removeprefix("file:")) if f.endswith(".parquet")]


def test_outputs_of_the_same_name_have_their_own_progress(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rec = C.DECLARATIONS[0]
    (src / "a.csv").write_text(",".join(C.RAW_COLS) + "\n" + ",".join(f'"{v}"' for v in rec) + "\n", encoding="utf-8")
    for parent in ("o1", "o2"):
        out = str(tmp_path / parent / "stg")
        start_staging_stream(spark, str(src), out, C.RAW_COLS).awaitTermination(120)
        assert spark.read.parquet(out).count() == 1


def test_schema_profile_and_find_columns(spark, fx):
    prof = schema_profile(spark, fx["rx"]).collect()
    assert [(r["position"], r["name"]) for r in prof][:2] == [(0, "ben_reg"), (1, "psp_spe")]
    assert find_columns(fx["rx"], ["dep", "reg", "dpt"]) == ["ben_reg"]
    pos = first_rows_by_position(fx["regions"], 1, order=[F.asc("code")]).collect()
    assert [(r["row"], r["position"], r["value"]) for r in pos] == [(0, 0, "11"), (0, 1, "Île-de-France")]
    unordered = first_rows_by_position(fx["regions"], 3).collect()
    assert sorted({r["row"] for r in unordered}) == [0, 1, 2] and len(unordered) == 6


def test_column_search_filters_the_profile(spark, fx):
    found = search_columns(schema_profile(spark, fx["rx"]), ["dep", "reg", "dpt"]).collect()
    assert [(r["position"], r["name"]) for r in found] == [(0, "ben_reg")]
    assert search_columns(schema_profile(spark, fx["rx"]), []).count() == 0


def test_json_file_round_trip(spark, fx):
    path = write_json(fx["regions"], scratch_path(spark, "json"))
    assert rows(spark.read.schema(fx["regions"].schema).json(path)) == rows(fx["regions"])


def test_scratch_tables_can_be_removed(spark):
    import os
    from sunlight.session import clear_scratch
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path.removeprefix("file:"))
    assert clear_scratch(spark) and not os.path.exists(path.removeprefix("file:"))
