"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from laketide.plans.catalog import QUERIES
from laketide.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_parity(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, got) == _canon(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["r_name", "c_mktsegment", "o_year", "revenue", "n_lines", "gid"]
