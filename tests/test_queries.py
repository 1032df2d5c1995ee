"""Every named query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()


def plain(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith(("float", "Float")):
            df[c] = df[c].round(6)
        df[c] = df[c].astype(str).replace({"<NA>": "None", "nan": "None", "NaT": "None", "True": "true", "False": "false"}).str.replace(r" 00:00:00$|\.0$", "", regex=True)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def con(tiny):
    c = duckdb.connect()
    for f in os.listdir(tiny):
        c.sql(f"create view {f.split('.')[0]} as select * from '{tiny}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tiny, con, name):
    got = plain(entry.queries()[name](spark, tiny).toPandas())
    want = plain(con.sql(SQL[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
