"""Every registered query against its DuckDB twin on the smallest scale factor."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return ""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else "f" + repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return "v" + repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["lon", "lat", "windowEnd", "isStart", "cnt"]
    df.collect()


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[key])
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_query_has_an_oracle():
    from tripstream.plans import oracle, queries
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
