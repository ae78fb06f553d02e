"""Every registered query against its SQL on the small tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from sparkseries.queries import ORACLE, QUERIES
from tools.check_oracle import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for table in TABLES:
        made.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return made


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    _seconds, _rows, problems = compare(spark, connection, name, QUERIES[name], ORACLE.get(name), FOLDER)
    assert not problems


def test_entry(spark):
    assert entry.entry(spark).columns == ["series", "date", "user_id", "value", "created_at"]


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLE) == set()
