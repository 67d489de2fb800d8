"""Every registered query against its SQL on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()
#: Queries without SQL have tests of their own.
COMPARED = [name for name in QUERIES if name in SQL]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    ours = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(SQL[name])
    theirs = normal([c[0] for c in cursor.description], cursor.fetchall())
    assert ours == theirs
    assert ours[1], "no rows to compare"


def test_entry(spark):
    assert contract.entry(spark).count() > 0
