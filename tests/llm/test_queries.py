"""Registered queries against their SQL in DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from sluice.llm.queries import ORACLES, QUERIES


def test_registered():
    found = entry.queries()
    assert set(QUERIES) <= set(found) and "pipeline" in found
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    rel = con.sql(ORACLES[name])
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(rel.columns)
    assert sorted(map(repr, map(tuple, got.select(*rel.columns).collect()))) == sorted(map(repr, rel.fetchall()))
