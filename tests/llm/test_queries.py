"""The registered queries: names, oracles, whole tables."""
import re

import duckdb
import pytest

import __spark_entry__ as E
from finmesh.llm import queries
from finmesh.llm.common import table
from tests.conftest import SF001
from tools.oracle_check import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_all_are_registered():
    names = set(E.queries())
    assert {re.match(r"op\d+_", n)[0] for n in names if n.startswith("op")} >= {f"op{i}_" for i in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLE) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(rows, df.columns) == digest(res.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE) - {"pipeline", "op9_packing", "op11_spelling_variants"}))
def test_one_row_per_row(spark, name):
    """The others are compared with brute force in the test of their operator."""
    source = "pages" if name == "op7_html_main" else "documents"
    assert E.queries()[name](spark, SF001).count() == table(spark, SF001, source).count()
