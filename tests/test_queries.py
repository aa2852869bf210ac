"""Every registered query against its SQL, over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

NAMES = sorted(n for n in entry.queries() if n.startswith("q_"))


@pytest.fixture(scope="module")
def views(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    return round(v, 5) + 0.0 if isinstance(v, float) and math.isfinite(v) else v


def rows(names, values):
    at = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in at) for r in values), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf_dir, views, name):
    df = entry.queries()[name](spark, sf_dir)
    got = rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = views.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert got == rows(want.columns, want.fetchall())


def test_entry(spark, sf_dir):
    assert entry.entry(spark).count() > 0
