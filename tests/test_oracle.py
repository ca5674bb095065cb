"""Every catalogue query against its DuckDB oracle on the smallest fixtures."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SMALL
from tools.oracle_check import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SMALL).toPandas()
    odf = con.execute(E.oracle_sql()[key]).df()
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(odf)
    assert sc == oc
    assert sr == orr


def test_every_query_has_oracle():
    assert set(E.QUERIES) == set(E.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "OmniExtension" in df.columns and "UserToken" in df.columns
