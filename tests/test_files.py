import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructType

from spanlake.session import scratch_path
from spanlake.sources.files import (
    read_csv,
    read_table,
    row_count,
    with_load_columns,
    write_observed,
    write_table,
)
from spanlake.sources.schemas import period_schema, snapshot_schema

SCHEMA = (
    StructType()
    .add("ID", LongType())
    .add("S", StringType())
    .add("N", DoubleType())
    .add("T", StringType())
)
LINES = [
    "ZID,S,N,T",
    "1,a,1.5,x",
    ",b,oops,y",
    '3,"q""q",NaN,"multi',
    'line"',
    "",
    '4,"",,z,extra',
    "5,short",
]


def _file(tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    return str(path)


def _rows(df):
    return [
        tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in r)
        for r in df.collect()
    ]


def test_schemas_have_the_published_shape(spark):
    def kinds(schema):
        names = [f.dataType.simpleString() for f in schema]
        return {k: names.count(k) for k in ("string", "int", "double", "bigint")}

    assert kinds(snapshot_schema()) == {"string": 27, "int": 17, "double": 4, "bigint": 2}
    assert kinds(period_schema()) == {"string": 19, "int": 19, "double": 41, "bigint": 3}


def test_permissive_csv_by_line(spark, tmp_path):
    assert _rows(read_csv(spark, _file(tmp_path), SCHEMA)) == [
        (1, "a", 1.5, "x"),
        (None, "b", None, "y"),
        (3, 'q"q', "NaN", "multi"),
        (None, None, None, None),
        (4, None, None, "z"),
        (5, "short", None, None),
    ]


def test_multi_line_csv_keeps_quoted_breaks(spark, tmp_path):
    rows = _rows(read_csv(spark, _file(tmp_path), SCHEMA, multi_line=True))
    assert (3, 'q"q', "NaN", "multi\nline") in rows
    assert len(rows) == 5


def test_corrupt_records_can_be_kept(spark, tmp_path):
    df = read_csv(spark, _file(tmp_path), SCHEMA, corrupt_column="bad")
    rows = _rows(df)
    assert len(rows) == 6
    assert [r[4] for r in rows] == [None, ",b,oops,y", None, 'line"', '4,"",,z,extra', "5,short"]


def test_header_is_checked_on_request(spark, tmp_path):
    with pytest.raises(Exception, match="CSV header does not conform to the schema"):
        read_csv(spark, _file(tmp_path), SCHEMA, check_header=True).collect()


def test_load_columns(spark):
    row = with_load_columns(spark.range(1), "f.csv").first()
    assert (row["source_file"], row["layer"]) == ("f.csv", "BRONZE")
    assert row["load_time"] is not None


def test_written_rows_are_counted_from_storage(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_observed(spark.range(10), path) == (10, 10)
    assert write_observed(spark.range(3), path) == (3, 3)
    assert row_count(read_table(spark, path)).first()["rows"] == 3
    assert write_table(spark.range(0), path).count() == 0


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and first != second


def test_footers_answer_a_count(spark, tmp_path):
    written = write_table(spark.range(10).withColumn("x", F.lit("y")), str(tmp_path / "t"))
    plan = row_count(written)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
