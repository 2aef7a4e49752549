"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from ledgerline import oracle
from ledgerline.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.REGISTRY) == set(oracle.all_queries())
    assert set(catalog.REGISTRY) <= set(entry.queries()) and set(catalog.REGISTRY) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["activity_month", "country", "deposits_amount_usd", "withdrawals_amount_usd", "bets_amount_usd", "loaded_at"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got_cols, got = df.columns, [tuple(r) for r in df.collect()]
    cur = duck.execute(entry.oracle_sql()[name])
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    assert len(got) == len(want)
    assert _canon(got_cols, got) == _canon(want_cols, want)
