"""Driver contract: entry() runs; every query agrees with its DuckDB oracle."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _norm(v):
    if isinstance(v, float | decimal.Decimal):
        return round(float(v), 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["year_woy", "distinct_daily_users"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(entry._QUERIES) == set(entry._ORACLES)
    assert set(entry._QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry._QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry._QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(entry._ORACLES[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())
