"""Report of a range of months, and cells of CSV files that do not fit their type."""

import random

import pytest
from pyspark.sql import functions as F

from spanlake.operators.intervals import Roles
from spanlake.operators.report import METRICS, clustered, monthly_report, report_for_months
from spanlake.sources.files import BAD_CELLS, quarantine, read_csv_cells

from test_incremental import PERIOD, ROLES, periods


@pytest.mark.parametrize("seed", range(2))
def test_months_of_the_full_report(spark, seed):
    rng = random.Random(seed)
    df = spark.createDataFrame(list(periods(rng, 80)), PERIOD)
    full = {r[0]: repr(tuple(r)) for r in monthly_report(df, None, ROLES).collect()}
    for first, last in (("200003", "200107"), ("200012", "200012"), ("200001", "200112")):
        found = report_for_months(df, first, last, ROLES, METRICS).collect()
        assert [r[0] for r in found] == sorted(m for m in full if first <= m <= last)
        assert [repr(tuple(r)) for r in found] == [full[r[0]] for r in found]


def test_months_without_periods_are_zero(spark):
    df = spark.createDataFrame([(1, "a", 5.0, "200003", "200004", 0)], PERIOD)
    found = [tuple(r) for r in report_for_months(df, "199912", "200003", ROLES).collect()]
    assert found[0] == ("199912", 0, 0, 0.0, 0.0, 0) and found[-1] == ("200003", 1, 1, 5.0, 5.0, 0)
    assert len(found) == 4 and report_for_months(df, "200005", "200004", ROLES).count() == 0
    with pytest.raises(ValueError):
        report_for_months(df, "200013", "200101", ROLES)


def test_comparisons_reach_the_scan_and_files_are_clustered(spark, tmp_path):
    rows = spark.range(4000).selectExpr(
        "int(id % 7) person", "'e' employer", "1D salary",
        "string(200001 + id % 12 + 100 * (id % 10)) s", "string(200001 + id % 12 + 100 * (id % 10)) e",
    )
    path = str(tmp_path / "p")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small ranges stay apart
    try:
        clustered(rows, "e", "s").write.parquet(path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(path)
    ends = stored.groupBy(F.input_file_name()).agg(F.min("e").alias("a"), F.max("e").alias("b")).collect()
    spans = sorted((r.a, r.b) for r in ends)
    assert len(spans) > 2 and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
    plan = report_for_months(stored, "200901", "200912", Roles("person", "employer", "salary", "s", "e"))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(s,200912)" in shown and "GreaterThanOrEqual(e,200901)" in shown


def test_bad_cells_are_named_exactly(spark, tmp_path):
    lines = ["a,b,c,d", "1,2.5,x,2020-01-01", "x,,y,2020-13-01", ",1e400z,,", '3," ","q,""r""",no', "7", "8,9,z,2020-02-02,extra"]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    schema = spark.createDataFrame([], "a int, b double, c string, d date").schema
    good, refused = quarantine(read_csv_cells(spark, str(tmp_path / "t.csv"), schema))
    bad = {tuple((c.field, c.text) for c in r[BAD_CELLS]): (r.a, r.b, r.c) for r in refused.collect()}
    assert bad == {
        (("a", "x"), ("d", "2020-13-01")): (None, None, "y"),
        (("b", "1e400z"),): (None, None, None),
        (("d", "no"),): (3, None, 'q,"r"'),
    }
    assert good.columns == ["a", "b", "c", "d"]
    assert sorted(r.a for r in good.collect()) == [1, 7, 8]
