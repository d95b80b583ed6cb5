"""Every query against its SQL in DuckDB, on the smallest test data."""

import math
from pathlib import Path

import pytest

from inkmill import catalogue

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    made = duckdb.connect()
    made.execute("SET timezone = 'UTC'")
    for p in DATA.glob("*.parquet"):
        made.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return made


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float)):
        return "None" if isinstance(v, float) and math.isnan(v) else f"{float(v):.6f}"
    return str(v)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    found = duck.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in found.fetchall())
    assert got


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalogue.queries()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
