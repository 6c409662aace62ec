import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from spanlake.operators.intervals import Roles, expand, month_bounds, month_dim, range_join, sweep
from spanlake.operators.report import (
    METRICS,
    fill_gaps,
    monthly_report,
    present,
    report_by_expansion,
    report_by_range_join,
    report_by_sweep,
    report_summary,
)

SCHEMA = (
    "SO_SO_BHXH string, MA_DON_VI string, MUC_LUONG double, TU_THANG string, DEN_THANG string"
)


def index(text):
    return int(text[:4]) * 12 + int(text[4:]) - 1


def text(i):
    return f"{i // 12:04d}{i % 12 + 1:02d}"


def brute_force(rows):
    """The report in plain Python."""
    usable = [r for r in rows if r[3] and r[4] and r[3] <= r[4]]
    if not usable:
        return []
    result = []
    for i in range(min(index(r[3]) for r in usable), max(index(r[4]) for r in usable) + 1):
        active = [r for r in usable if index(r[3]) <= i <= index(r[4])]
        paid = [r[2] for r in active if r[2] is not None]
        positive = [p for p in paid if p > 0 or math.isnan(p)]
        total = sum(paid)
        mean = sum(positive) / len(positive) if positive else 0.0
        result.append(
            (
                text(i),
                len({r[0] for r in active if r[0] is not None}),
                len({r[1] for r in active if r[1] is not None}),
                0.0 if math.isnan(total) else float(total),
                0.0 if math.isnan(mean) else float(mean),
                len({r[0] for r in active if r[2] == 0 and r[0] is not None}),
            )
        )
    return result


def assert_report(df, expected):
    rows = [tuple(r) for r in df.collect()]
    assert [r[:3] for r in rows] == [e[:3] for e in expected]
    assert [r[5] for r in rows] == [e[5] for e in expected]
    for r, e in zip(rows, expected):
        assert r[3] == pytest.approx(e[3], abs=1e-6), r
        assert r[4] == pytest.approx(e[4], abs=1e-6), r


def strategies(df):
    dim = month_dim(df)
    return {
        "sweep": report_by_sweep(None, df),
        "sweep on axis": report_by_sweep(dim, df),
        "expansion": report_by_expansion(dim, df),
        "range join": report_by_range_join(dim, df),
    }


def random_rows(seed, odd=False):
    rng = random.Random(seed)
    pays = [0.0, 0.0, 1000.0, 2500.5, 1e9, None, -3.25]
    if odd:
        pays += [float("nan"), float("inf"), float("-inf")]
    rows = []
    for _ in range(rng.randrange(1, 60)):
        first = 24000 + rng.randrange(60)
        rows.append(
            (
                rng.choice(["a", "b", "c", "d", None]),
                rng.choice(["x", "y", "z", None]),
                rng.choice(pays),
                text(first),
                text(first + rng.choice([0, 0, 1, 2, 5, 30])),
            )
        )
    return rows


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("odd", [False, True])
def test_all_strategies_equal_brute_force(spark, seed, odd):
    rows = random_rows(seed, odd)
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute_force(rows)
    for report in strategies(df).values():
        assert_report(report, expected)


def test_edge_rows(spark):
    rows = [
        ("a", "x", 100.0, "202001", "202003"),
        ("a", "x", 100.0, "202002", "202003"),  # overlaps: one person, paid twice
        ("a", "y", 0.0, "202003", "202003"),
        (None, "x", 50.0, "202001", "202001"),  # no person, still paid
        ("b", None, 7.0, "202006", "202006"),  # after a gap of two months
        ("c", "z", 0.0, "202007", "202007"),  # only zero pay: mean 0
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = [
        ("202001", 1, 1, 150.0, 75.0, 0),
        ("202002", 1, 1, 200.0, 100.0, 0),
        ("202003", 1, 2, 200.0, 100.0, 1),
        ("202004", 0, 0, 0.0, 0.0, 0),
        ("202005", 0, 0, 0.0, 0.0, 0),
        ("202006", 1, 0, 7.0, 7.0, 0),
        ("202007", 1, 1, 0.0, 0.0, 1),
    ]
    assert brute_force(rows) == expected
    for report in strategies(df).values():
        assert_report(report, expected)


def test_year_zero_and_the_last_month(spark):
    rows = [("a", "x", 1.0, "000001", "000002"), ("b", "x", 1.0, "000101", "000101")]
    for report in strategies(spark.createDataFrame(rows, SCHEMA)).values():
        assert_report(report, brute_force(rows))
    rows = [("a", "x", 1.0, "999911", "999912")]
    for report in strategies(spark.createDataFrame(rows, SCHEMA)).values():
        assert_report(report, brute_force(rows))


def test_malformed_and_reversed_rows_do_not_count(spark):
    rows = [
        ("a", "x", 5.0, "202001", "202002"),
        ("b", "x", 5.0, "202002", "202001"),
        ("c", "x", 5.0, "2020-1", "202002"),
        ("d", "x", 5.0, None, "202002"),
        ("e", "x", 5.0, "202001", None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute_force([rows[0]])
    for report in strategies(df).values():
        assert_report(report, expected)


def test_no_valid_month_gives_an_empty_report(spark):
    df = spark.createDataFrame([("a", "x", 1.0, "bad", "202001")], SCHEMA)
    assert month_dim(df).count() == 0
    assert month_dim(df).schema.simpleString() == "struct<THANG_ID:string>"
    for report in strategies(df).values():
        assert report.count() == 0


def test_axis_reaches_over_well_formed_rows(spark):
    rows = [
        ("a", "x", 1.0, "201911", "202002"),
        ("b", "x", 1.0, "202005", "202001"),
        ("c", "x", 1.0, "nope", "203001"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert tuple(month_bounds(df).first()) == ("201911", "202002")
    assert [r[0] for r in month_dim(df).orderBy("THANG_ID").collect()] == [
        "201911",
        "201912",
        "202001",
        "202002",
    ]


def test_a_given_axis_decides_the_months(spark):
    rows = [("a", "x", 10.0, "202001", "202012")]
    df = spark.createDataFrame(rows, SCHEMA)
    axis = spark.createDataFrame([("202006",), ("202012",), ("202101",)], "THANG_ID string")
    report = monthly_report(df, axis)
    assert [tuple(r)[:4] for r in report.collect()] == [
        ("202006", 1, 1, 10.0),
        ("202012", 1, 1, 10.0),
        ("202101", 0, 0, 0.0),
    ]


def test_expansion_has_one_row_per_month(spark):
    rows = random_rows(11)
    df = spark.createDataFrame(rows, SCHEMA)
    months = sum(index(r[4]) - index(r[3]) + 1 for r in rows)
    assert expand(df).count() == months
    assert range_join(df, month_dim(df)).count() == months


def test_integer_keys_and_decimal_pay(spark):
    df = spark.sql(
        "SELECT 1L p, 2 e, CAST(1.25 AS decimal(10,2)) s, '202001' f, '202002' t"
        " UNION ALL SELECT 1L, 3, CAST(0 AS decimal(10,2)), '202002', '202002'"
    )
    roles = Roles("p", "e", "s", "f", "t")
    report = report_by_sweep(None, df, roles)
    assert [tuple(r) for r in report.collect()] == [
        ("202001", 1, 1, 1.25, 1.25, 0),
        ("202002", 1, 2, 1.25, 1.25, 1),
    ]


def test_a_frequent_person_is_reduced_before_the_shuffle(spark):
    """A third of the rows on one person reach the window as one row per start month."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("SO_SO_BHXH"),
        F.lit("x").alias("MA_DON_VI"),
        F.lit(1.0).alias("MUC_LUONG"),
        F.format_string("2020%02d", F.col("id") % 12 + 1).alias("TU_THANG"),
        F.lit("202012").alias("DEN_THANG"),
    )
    plan = sweep(df, Roles())._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    december = report_by_sweep(None, df).collect()[-1]
    assert (december["THANG_ID"], december["SO_NGUOI_THAM_GIA"]) == ("202012", 20_001)
    assert december["TONG_QUY_LUONG"] == 30_000.0


def test_gap_filling_replaces_nan(spark):
    dim = spark.createDataFrame([("202001",), ("202002",)], "THANG_ID string")
    monthly = spark.createDataFrame(
        [("202001", 1, 1, float("nan"), None, None)],
        "THANG_ID string, SO_NGUOI_THAM_GIA bigint, SO_DON_VI bigint, TONG_QUY_LUONG double,"
        " LUONG_BINH_QUAN double, SO_NGUOI_LUONG_0 bigint",
    )
    assert [tuple(r) for r in fill_gaps(dim, monthly).collect()] == [
        ("202001", 1, 1, 0.0, 0.0, 0),
        ("202002", 0, 0, 0.0, 0.0, 0),
    ]


def test_summary_and_presentation(spark):
    rows = [("a", "x", 1234567.5, "202001", "202002"), ("b", "y", 0.0, "202002", "202002")]
    report = monthly_report(spark.createDataFrame(rows, SCHEMA))
    assert tuple(report_summary(report).first()) == (2, 2469135.0, 1)
    shown = present(report)
    assert shown.columns[0] == "Tháng"
    assert tuple(shown.collect()[1]) == ("2020-02", "2", "2", "1,234,568", "1,234,568", "1")


def test_report_plan_stays_in_the_jvm_without_nested_loops(spark):
    df = spark.createDataFrame(random_rows(1), SCHEMA)
    plan = monthly_report(df)._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEval", "NestedLoop", "Cartesian"):
        assert word not in plan


def test_amounts_are_exact_for_every_double(spark):
    pays = [1e25, 1e-8, 0.1234567891, -1e25, 5e-324, 1.7e308, -1.7e308, 3.0, 2.0**53 + 2, -7.25, 1e16, 1.0]
    rows = [("a", "x", p, "202001", text(24240 + i)) for i, p in enumerate(pays)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = {}
    for i in range(24240, 24240 + len(pays)):
        active = [Fraction(p) for k, p in enumerate(pays) if 24240 + k >= i]
        positive = [p for p in active if p > 0]
        expected[text(i)] = (float(sum(active)), float(sum(positive) / len(positive)) if positive else 0.0)
    for report in strategies(df).values():
        got = {r["THANG_ID"]: (r["TONG_QUY_LUONG"], r["LUONG_BINH_QUAN"]) for r in report.collect()}
        assert got.keys() == expected.keys()
        for month, values in expected.items():
            assert got[month] == pytest.approx(values, rel=1e-15), month


def test_sums_do_not_depend_on_the_order(spark):
    rng = random.Random(2)
    rows = [("a", "x", rng.uniform(-1, 1) * 10 ** rng.randrange(-9, 20), "202001", "202003") for _ in range(3000)]
    reports = set()
    for partitions in (1, 3, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
        for report in strategies(df).values():
            reports.add(tuple(map(tuple, report.collect())))
    assert len(reports) == 1
    assert reports.pop()[0][3] == pytest.approx(float(sum(Fraction(r[2]) for r in rows)), rel=1e-15)


def test_a_cell_of_any_size_does_not_stop_the_report(spark):
    rows = [("a", "x", 1e300, "202001", "202001"), ("b", "x", 1e300, "202001", "202001")]
    (row,) = monthly_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (row["TONG_QUY_LUONG"], row["LUONG_BINH_QUAN"]) == (2e300, 1e300)


def test_only_wanted_metrics_are_planned(spark):
    df = spark.createDataFrame(random_rows(3), SCHEMA)
    whole = {r["THANG_ID"]: r.asDict() for r in monthly_report(df).collect()}
    for metric in METRICS:
        report = monthly_report(df, metrics=(metric,))
        assert report.columns == ["THANG_ID", metric]
        assert {r["THANG_ID"]: r[metric] for r in report.collect()} == {
            m: r[metric] for m, r in whole.items()
        }
    pay = monthly_report(df.drop("SO_SO_BHXH", "MA_DON_VI"), metrics=("TONG_QUY_LUONG",))
    plan = pay._jdf.queryExecution().optimizedPlan().toString()
    assert "_person" not in plan and "_employer" not in plan


def test_column_names_with_backticks(spark):
    df = spark.createDataFrame([("p", "e", 2.5, "202001", "202002")], "`a`` b` string, e string, `s``` double, f string, t string")
    report = monthly_report(df, roles=Roles("a` b", "e", "s`", "f", "t"))
    assert [tuple(r) for r in report.collect()][0] == ("202001", 1, 1, 2.5, 2.5, 0)
