"""Every registered query against its DuckDB oracle on the small tables."""

import os
import sys

import duckdb
import pytest

from table_dirs import SF001

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        pytest.skip("rows-only query")
    cur = con.execute(ORACLES[name])
    want, wc = rows_of([d[0] for d in cur.description], cur.fetchall())
    got, gc = rows_of(df.columns, rows)
    assert gc == wc
    assert got == want
