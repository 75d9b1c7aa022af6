"""Every registered query against its DuckDB statement on sf0.001 (the
driver runs the same comparison on sf0.01)."""

import duckdb
import pytest

from paths import SF_SMALL
from oracle_check import TABLES, compare

import __spark_entry__ as E


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_parity(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    err = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert err is None, err
