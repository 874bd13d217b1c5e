"""Every registered query against its SQL in DuckDB, on the whole sample tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle import sql as oracle
from playlens import registry
from tests.conftest import SAMPLE


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in glob.glob(f"{SAMPLE}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracle.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracle.QUERIES))
def test_query_equals_sql(spark, database, name):
    got = entry.queries()[name](spark, SAMPLE)
    want = database.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    places = [want.columns.index(c) for c in columns]
    left = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    right = sorted((tuple(r[i] for i in places) for r in want.fetchall()), key=repr)
    assert left == right


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [r.device_type for r in rows][0] == "MOBILE" and len(rows) == 4
