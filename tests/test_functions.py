"""FIXTURES.md B3: scalar expressions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sunlight.functions import (department_code, escape_like, format_amount, fr_grouped_integer,
                                group_key, normalise_lab_name, parse_comma_decimal,
                                parse_fr_number, postal_code, round_half_up, speciality_label,
                                split_coordinate, strip_leading_article, to_money_text)
from sunlight.plans.prescriptions import speciality_key


def one(spark, expr, value, type_="string"):
    df = spark.createDataFrame([(value,)], f"x {type_}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_comma_decimal_rounds_half_up(spark):
    assert one(spark, parse_comma_decimal, "1.005") == Decimal("1.01")
    assert one(spark, parse_comma_decimal, "-2.345") == Decimal("-2.35")
    assert one(spark, parse_comma_decimal, "1200,50") == Decimal("1200.50")


def test_comma_decimal_rejects_grouped_text(spark):
    with pytest.raises(Exception):
        one(spark, parse_comma_decimal, "1.234,56")
    assert one(spark, lambda c: parse_comma_decimal(c, strict=False), "1.234,56") is None
    with pytest.raises(Exception):
        one(spark, parse_comma_decimal, "")
    assert one(spark, lambda c: parse_comma_decimal(c, strict=False), "") is None


def test_fr_number_two_replace(spark):
    assert one(spark, parse_fr_number, "1.234,56") == Decimal("1234.560")
    assert one(spark, parse_fr_number, "12.50") == Decimal("1250.000")
    assert one(spark, lambda c: parse_fr_number(c, null_as="0"), None) == Decimal("0.000")
    assert one(spark, lambda c: parse_fr_number(c, null_as="0"), "  ") == Decimal("0.000")


def test_money_text_round_trip(spark):
    assert one(spark, to_money_text, 68423.46, "double") == "68423,46"
    assert one(spark, lambda c: to_money_text(c, grouped=True), 1234567.5, "double") == "1.234.567,50"
    assert one(spark, lambda c: to_money_text(c, grouped=True), 23.0, "double") == "23,00"
    assert one(spark, lambda c: to_money_text(c, grouped=True), -1234.5, "double") == "-1.234,50"


@pytest.mark.parametrize("raw,padded,dept", [("1234", "01234", "01"), ("1234567", "12345", "12"),
                                             ("", "00000", "00"), ("75011", "75011", "75")])
def test_postal_and_department(spark, raw, padded, dept):
    assert one(spark, postal_code, raw) == padded
    assert one(spark, department_code, raw) == dept


@pytest.mark.parametrize("raw,code", [("x", None), (" 12 ", 12), ("3.7", 4), ("2.5", 3), ("1e40", None),
                                      ("1D", None), ("2f", None), ("", None), ("  ", None), ("0x1", None), ("-3", -3)])
def test_speciality_key(spark, raw, code):
    df = spark.createDataFrame([(raw,)], "psp_spe string")
    assert df.select(speciality_key("psp_spe").alias("k")).first()["k"] == code


@pytest.mark.parametrize("name,expected", [
    ("SANOFI AVENTIS FRANCE", "NOFI AVENTIS "),
    ("PFIZER S.A.S", "PFIZER "),
    ("ABBVIE S.A.", "ABBVIE ."),
    ("GSK SPAIS", "GSK "),
    ("BAYER SANTE", "BAYER NTE"),
    ("Laboratoires Théa", "LABORATOIRES THÉA"),
])
def test_name_normaliser_quirks(spark, name, expected):
    assert one(spark, normalise_lab_name, name) == expected


@pytest.mark.parametrize("name,expected", [("LES LABORATOIRES SERVIER", "LABORATOIRES"),
                                           ("Laboratoires Théa SAS", "Théa"), ("LABO X", "X"),
                                           ("", "")])
def test_group_fallback_first_word(spark, name, expected):
    assert one(spark, lambda c: group_key(c, rules=[]), name) == expected


def test_group_rules_first_match(spark):
    rules = [(("SANOFI", "OPELLA"), "SANOFI/OPELLA"), (("SAN",), "SAN")]
    assert one(spark, lambda c: group_key(c, rules), "SANOFI PASTEUR") == "SANOFI/OPELLA"
    assert one(spark, lambda c: group_key(c, rules), "SANDOZ") == "SAN"
    assert one(spark, lambda c: group_key(c, rules), "Les Biogaran x") == "Biogaran"
    assert one(spark, strip_leading_article, "labo Y") == "Y"


def test_split_coordinate(spark):
    assert one(spark, lambda c: split_coordinate(c, 2), "48.8, 2.35") == 2.35
    with pytest.raises(Exception):
        one(spark, lambda c: split_coordinate(c, 2), "48.8")
    assert one(spark, lambda c: split_coordinate(c, 2, strict=False), "48.8") is None


def test_round_half_up_on_decimal_value(spark):
    assert one(spark, lambda c: round_half_up(c, 2), 1.005, "double") == 1.01
    assert one(spark, lambda c: round_half_up(c, 0), 2.5, "double") == 3.0


def test_ilike_semantics(spark):
    df = spark.createDataFrame([("ÉLISE", "MEDECIN")], "a string, b string")
    r = df.select(F.col("a").ilike("élise").alias("x"), F.col("b").ilike("Médecin%").alias("y")).first()
    assert r["x"] is True and r["y"] is False


def test_speciality_rules(spark):
    df = spark.createDataFrame([("médecin généraliste",), ("Docteur X",), ("PHARMACIEN",),
                                ("Infirmier",), (None,)], "s string")
    got = [r["s"] for r in df.select(speciality_label("s").alias("s")).collect()]
    assert got == ["Médecin", "Médecin", "Pharmacien", "Infirmier", None]


def test_escape_like():
    assert escape_like("a\\b") == "a\\\\b"
    assert escape_like("50%_x") == "50%_x"
    assert escape_like("50%_x", literal=True) == "50\\%\\_x"


def test_report_formatting(spark):
    assert one(spark, format_amount, 9_901_000_000.0, "double") == "9,9 Milliards d'euros"
    assert one(spark, format_amount, 1_250_000.0, "double") == "1,3 M€"
    assert one(spark, fr_grouped_integer, 1234567.5, "double") == "1\u202f234\u202f568"


def test_partition_sizing():
    from sunlight.session import MOST_REDUCERS, partitions_for, split_bytes_for
    mb, tb = 1 << 20, 1 << 40
    assert partitions_for(10 * mb) == 8                                   # the least
    assert partitions_for(100 * 1024 * mb) == 100                         # a quarter is shuffled, 256 MB each
    assert partitions_for(100 * tb) == MOST_REDUCERS
    assert split_bytes_for(10 * mb) == 128 * mb and split_bytes_for(100 * tb) == 1024 * mb
    blocks = (100 * tb // split_bytes_for(100 * tb)) * partitions_for(100 * tb)
    assert blocks < 3e9                                                   # what the driver tracks at 100 TB


def test_default_partitions_follow_the_cluster():
    from types import SimpleNamespace as N
    from sunlight.session import default_partitions
    session = lambda master, cores: N(sparkContext=N(master=master, defaultParallelism=cores))
    assert default_partitions(session("local[8]", 8)) == 8
    assert default_partitions(session("yarn", 4000)) == 12_000
    assert default_partitions(session("k8s://x", 16)) == 200
