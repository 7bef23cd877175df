"""Every query with comparison SQL against DuckDB on the smallest tables."""

import numbers

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from sluice.catalogue import load, views

QUERIES, ORACLES = load()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in views.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    yield con
    con.close()


def cell(x):
    if x is None or (not hasattr(x, "__len__") and pd.isna(x)):
        return ""
    return repr(float(x)) if isinstance(x, numbers.Number) and not isinstance(x, bool) else str(x)


def table(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    rel = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(rel.columns)
    assert {c: TYPES[t] for c, t in got.dtypes} == dict(zip(rel.columns, map(str, rel.types)))
    assert table(got.toPandas()) == table(rel.df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_gives_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(views.VIEWS))
def test_views_are_equal_text(spark, duck, sf_dir, name):
    got = views.view(spark, sf_dir, name)
    want = duck.sql(views.VIEWS[name].format(**{t: t for t in views.TABLES}))
    assert sorted(got.columns) == sorted(want.columns)
    assert got.count() == len(want.df())
