"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

SF = Path("/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_names():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    counts = driver.entry(spark).collect()
    assert sum(r.cnt for r in counts) == 66


@pytest.mark.parametrize("name", list(driver.queries()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    got = df.select(*columns).collect()
    assert got
    if name not in driver.oracle_sql():
        return
    result = duck.execute(driver.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    place = [[c[0] for c in result.description].index(c) for c in columns]
    expected = [tuple(row[i] for i in place) for row in result.fetchall()]

    def ordered(found):
        return sorted((tuple(r) for r in found), key=lambda r: tuple((v is None, str(v)) for v in r))

    assert ordered(got) == ordered(expected)
