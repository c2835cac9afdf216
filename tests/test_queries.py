"""Every registered query against its SQL oracle (DuckDB) on the smallest driver tables,
plus the entry smoke check."""
import duckdb
import pytest

import __spark_entry__ as E
from finmesh.plans import catalog
from tests.conftest import SF001
from tools.oracle_check import TABLES, digest

QUERIES = {k: q for k, q in E.queries().items() if k in catalog.queries()}
ORACLE = {k: q for k, q in E.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["sector_name", "allocated_amount"]


def test_every_query_has_an_oracle_or_is_declared():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(rows, df.columns) == digest(orows, ocols)
