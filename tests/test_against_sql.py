"""Every registered query against plain SQL on the same tables."""

import datetime
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_module
from tallywood.plans.checked import QUERIES
from tallywood.plans.plain_sql import ORACLES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("events", "lineitem", "orders", "documents", "pages")
# Spark type name to DuckDB type name.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')"
        )
    yield connection
    connection.close()


def cell(value):
    assert not isinstance(value, Decimal)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def as_rows(records, order):
    return sorted(tuple(cell(record[i]) for i in order) for record in records)


def test_every_query_has_sql():
    """But for training-data operators that SQL cannot express."""
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_same_rows(spark, duck, name):
    result = entry_module.queries()[name](spark, FOLDER)
    expected = duck.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    spark_types = {f.name: SAME_TYPE[f.dataType.simpleString()] for f in result.schema.fields}
    assert spark_types == {d[0]: str(d[1]) for d in expected.description}
    names = sorted(columns)
    got = as_rows(result.collect(), [result.columns.index(n) for n in names])
    want = as_rows(expected.fetchall(), [columns.index(n) for n in names])
    assert got, "a query that finds nothing checks nothing"
    assert got == want


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4
