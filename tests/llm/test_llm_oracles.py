"""Every text query that SQL can express, against its SQL on the whole tables."""

import os

import duckdb
import pytest

from spanlake.llm.oracles import ORACLES
from spanlake.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(table):
    names = sorted(table.column_names)
    return sorted(zip(*[table.column(n).to_pylist() for n in names]), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    made, wanted = QUERIES[name](spark, SF_DIR).toArrow(), db.sql(ORACLES[name]).to_arrow_table()
    assert sorted(made.column_names) == sorted(wanted.column_names)
    assert rows(made) == rows(wanted)
