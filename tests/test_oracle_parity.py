"""Every registered query of the retail pipeline against its SQL oracle (DuckDB) on sf0.001:
same columns, same rows (exact)."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from retailflow.plans.oracle import oracle_queries
from retailflow.plans.queries import all_queries

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, Decimal):
            return float(v)
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v

    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, con, name):
    df = all_queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = oracle_queries().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert _bag(df.columns, rows) == _bag(o_cols, cur.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.collect()) > 0
    assert "revenue_share_pct" in df.columns
