"""Each query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest
from data_folder import DATA

from lexalign.plans import catalog


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def same(a, b):
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) if isinstance(a, float) and isinstance(b, float) else a == b


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, DATA)
    want = con.sql(catalog.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    order = [want.columns.index(c) for c in columns]
    rows = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
    assert len(got) == len(rows)
    assert all(same(x, y) for a, b in zip(got, rows, strict=True) for x, y in zip(a, b, strict=True)), next((a, b) for a, b in zip(got, rows, strict=True) if a != b)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_rows(spark, name):
    assert catalog.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
