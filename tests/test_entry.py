"""Driver contract: entry() and the Spark-vs-DuckDB oracle at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from equiscope.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "excess_degrees_from_median_expected_pvalue" in df.columns


def test_every_query_has_oracle_or_is_listed():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    free = set(E.llm.QUERIES) if E.llm else set()  # those have tests of their own
    assert set(q) - free == set(o) - free


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_small(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    s_rows = sorted("|".join(norm(r[c]) for c in sorted(sdf.columns)) for r in sdf.collect())
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    d_rows = sorted("|".join(norm(r[i]) for i in order) for r in cur.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert s_rows == d_rows
