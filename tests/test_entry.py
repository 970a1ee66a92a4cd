import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

WITH_SQL = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def sql(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_against_sql(spark, sf, sql, name):
    df = entry.queries()[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = sql.execute(entry.oracle_sql()[name])
    at = {d[0]: i for i, d in enumerate(res.description)}
    assert sorted(at) == cols
    assert got == sorted((tuple(plain(r[at[c]]) for c in cols) for r in res.fetchall()), key=repr)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
