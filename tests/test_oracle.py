"""Every registered query against its DuckDB oracle on the smallest tables."""

import decimal
import json

import duckdb
import pytest

import __spark_entry__ as E
from suite.oracle import ORACLE
from suite.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return None if v is None else str(v)


def canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), sorted(json.dumps([norm(r[i]) for i in order]) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_the_oracle_stands_alone():
    """The SQL shares no code and no constant with what it checks."""
    import ast
    import suite.oracle
    tree = ast.parse(open(suite.oracle.__file__, encoding="utf-8").read())
    names = {a.name for n in ast.walk(tree) if isinstance(n, ast.Import) for a in n.names} | {
        n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)}
    assert names == {"re", "__future__"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_negative_control(spark, duck):
    """A deliberately different SQL must not match."""
    df = E.queries()["top_payers"](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    sql = E.oracle_sql()["top_payers"].replace("ORDER BY total_euros DESC", "ORDER BY total_euros")
    cur = duck.execute(sql)
    assert canon([d[0] for d in cur.description], cur.fetchall()) != got
