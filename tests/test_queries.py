"""Every registered query against its SQL on the smallest test tables."""

import os
from datetime import date, datetime

import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in registered.TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


OWN = [query.__name__ for query in registered.QUERIES]


def test_every_query_has_sql():
    assert set(OWN) == set(registered.own_oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, oracle, name):
    df = registered.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(comparable(row[c]) for c in columns) for row in df.collect()]
    cursor = oracle.execute(registered.own_oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = [tuple(comparable(row[i]) for i in order) for row in cursor.fetchall()]
    assert expected
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
