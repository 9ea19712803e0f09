"""Every registered query against its DuckDB oracle (the driver's check)."""
import collections
import datetime as dt

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from feedlens.plans import catalog

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_analytics_query_has_an_oracle():
    assert set(catalog.registry()) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns[:5] == ["dt", "dau", "views", "likes", "ctr"]
    assert 0 < df.count() <= 7


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = queries()[name](spark, SF_SMALL)
    rel = duck.sql(oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    s_rows = collections.Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    d_idx = [rel.columns.index(c) for c in cols]
    d_rows = collections.Counter(tuple(_norm(r[i]) for i in d_idx) for r in rel.fetchall())
    assert s_rows == d_rows
