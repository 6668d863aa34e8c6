"""Every query with a DuckDB equivalent has the same rows and columns; the others run."""

import math
import os

import duckdb
import pytest

from millrace.plans import catalog
from millrace.session import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return f"{float(v):.6g}" if hasattr(v, "as_tuple") else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    rel = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == columns
    assert found == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_has_every_query(spark):
    import __spark_entry__ as entry

    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
