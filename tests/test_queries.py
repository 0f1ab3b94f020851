"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry
from check_queries import TABLES, normal
from waybill.queries import catalog

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 500


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert normal(df.columns, df.collect()) == normal(columns, found.fetchall())
