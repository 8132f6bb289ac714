"""Every registered query against its SQL on the test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from checks import oracle, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings", "documents", "pages", "benchmark", "labels", "conversations"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def sorted_rows(table):
    columns = sorted(table.column_names)
    return columns, sorted(map(repr, zip(*[table[c].to_pylist() for c in columns])))


@pytest.mark.parametrize("name", driver.oracle_sql())
def test_same_rows_and_types_as_sql(spark, database, name):
    found = driver.queries()[name](spark, FOLDER).toArrow()
    wanted = database.sql(driver.oracle_sql()[name]).to_arrow_table()
    assert sorted_rows(found) == sorted_rows(wanted)
    for column in found.column_names:
        assert found.schema.field(column).type == wanted.schema.field(column).type


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["k", "x"] and result.count() > 0
