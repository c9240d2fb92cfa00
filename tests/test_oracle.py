"""Every registered query against its SQL on the small tables."""

import datetime
import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("ORACLE_FOLDER", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    connection.execute("SET timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(name, spark, database):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    # a check may run the SQL as a view, which takes one statement with fixed columns
    database.execute(f"CREATE OR REPLACE VIEW checked AS {SQL[name]}")
    cursor = database.execute(SQL[name])
    found = [column[0] for column in cursor.description]
    assert sorted(found) == columns
    expected = sorted(
        tuple(plain(row[found.index(c)]) for c in columns) for row in cursor.fetchall()
    )
    actual = sorted(tuple(plain(row[c]) for c in columns) for row in frame.collect())
    assert actual == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_has_rows(name, spark):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1


def test_entry(spark):
    assert entry.entry(spark).columns == ["day", "incoming", "automized", "automation_perc"]
