"""Every registered query against its SQL on the same tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from spanlake.plans.catalog import QUERIES
from spanlake.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    return tuple(value) if isinstance(value, list) else value


def as_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    oracle = duck.sql(ORACLES[name])
    assert {c: KINDS.get(t, t) for c, t in result.dtypes} == {
        c: str(t) for c, t in zip(oracle.columns, oracle.types)
    }
    expected = as_multiset(oracle.columns, oracle.fetchall())
    actual = as_multiset(result.columns, result.collect())
    assert actual.total() == expected.total()
    assert actual == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry_reports_months(spark):
    rows = entry(spark).collect()
    assert len(rows) == 45
    assert (rows[0]["THANG_ID"], rows[-1]["THANG_ID"]) == ("199802", "200110")
