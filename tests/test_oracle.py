"""Every registered job against its DuckDB twin on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from streamlake.sources.tables import TABLES

from conftest import SF_SMALL

SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, got) == _rows(dcols, res.fetchall())


def test_every_job_runs(spark):
    for name, job in E.queries().items():
        if name not in SQL:
            assert job(spark, SF_SMALL).count() > 0, name


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["l_orderkey", "o_orderdate", "o_orderpriority", "revenue"]
    assert df.count() == 9
