"""Every registered query against its SQL on the smallest given tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as driver

SF = Path("/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no given tables")


@pytest.fixture(scope="module")
def sql():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def ordered(rows, columns):
    names = sorted(columns)
    places = [columns.index(c) for c in names]
    return sorted(([r[i] for i in places] for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", driver.queries())
def test_query(spark, sql, name):
    df = driver.queries()[name](spark, str(SF))
    got, text = df.collect(), driver.oracle_sql().get(name)
    if text is None:
        assert got
        return
    result = sql.execute(text)
    columns = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    for mine, theirs in zip(ordered(got, df.columns), ordered(result.fetchall(), columns), strict=True):
        for a, b in zip(mine, theirs):
            assert a == b or (isinstance(a, float) and math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)), (mine, theirs)
