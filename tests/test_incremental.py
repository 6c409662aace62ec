"""Loads one after the other against a full run over all of them."""

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.functions.months import MONTH_TEXT
from spanlake.operators.incremental import (
    ReportState,
    latest_changes,
    latest_merge,
    report_load,
    report_of,
)
from spanlake.operators.intervals import Roles
from spanlake.operators.latest import latest_per_key
from spanlake.operators.report import METRICS, monthly_report
from spanlake.sources.files import write_table

KEYS, ORDER = ["person"], ["created", "id"]
SNAPSHOT = "id int, person string, created string, `IS x` int"


def day(i):
    return F.lit(f"2020-01-{i + 1:02d}").cast("timestamp")


@pytest.mark.parametrize("seed", range(3))
def test_any_split_equals_a_full_run(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice(["a", "b", "c", "d", None]), rng.choice([None, "1", "2", "3"]), i % 7)
        for i in range(60)
    ]
    rng.shuffle(rows)
    cuts = [0, *sorted(rng.sample(range(61), 3)), 60]
    loads = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
    table, seen, before, replaced = None, [], {}, {}
    for i, load in enumerate(loads):
        df = spark.createDataFrame(load, SNAPSHOT)
        table = write_table(latest_merge(table, df, day(i), KEYS, ORDER), str(tmp_path / str(i)))
        seen += load
        full = latest_per_key(spark.createDataFrame(seen, SNAPSHOT), KEYS, ORDER).collect()
        now = {r.person: tuple(r) for r in full}
        replaced |= {row: i + 1 for key, row in before.items() if now[key] != row}
        before = now
        found = table.collect()
        assert sorted(tuple(r)[:4] for r in found if not r.IS_DELETED) == sorted(now.values())
        gone = {tuple(r)[:4]: r.DELETED_AT.day for r in found if r.IS_DELETED}
        assert gone == replaced and len(found) == len(now) + len(gone)
        assert all((r.DELETED_AT is None) == (r.IS_DELETED == 0) for r in found)
        again = latest_merge(table, df, day(20), KEYS, ORDER)
        assert sorted(again.collect(), key=str) == sorted(found, key=str)


def test_changes_of_a_load(spark):
    first = spark.createDataFrame([(1, "a", "5", 0), (2, "b", "5", 0), (3, None, "5", 0)], SNAPSHOT)
    load = [(4, "a", "6", 0), (5, "b", "4", 0), (6, "b", None, 0), (7, "c", None, 0)]
    found = latest_changes(
        latest_merge(None, first, None, KEYS, ORDER), spark.createDataFrame(load, SNAPSHOT), KEYS, ORDER
    )
    assert {r.person: r.change for r in found.collect()} == {
        "a": "replaced", "b": "late", "c": "new", None: "untouched",
    }


def test_wide_rows_are_not_shuffled_for_a_small_load(spark, tmp_path):
    wide = spark.range(1000).selectExpr(
        "id", "string(id % 50) person", "string(id) created", "repeat('x', 500) wide"
    )
    table = write_table(latest_merge(None, wide, day(0), KEYS, ORDER), str(tmp_path / "t"))
    load = spark.createDataFrame([(5000, "1", "9999", "new")], wide.schema)
    merged = write_table(latest_merge(table, load, day(1), KEYS, ORDER), str(tmp_path / "u"))
    assert merged.where("IS_DELETED = 0").count() == 50 and merged.count() == 51
    plan = latest_merge(table, load, day(1), KEYS, ORDER)
    plan.collect()
    shown = plan._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in shown.split("\n") if "Exchange" in line and "wide" in line]
    assert not exchanged


ROLES = Roles("person", "employer", "salary", "s", "e")
PERIOD = "person int, employer string, salary double, s string, e string, x int"


def periods(rng, count, first=0):
    nan, inf = float("nan"), float("inf")

    def month():
        return f"20{rng.randint(0, 1):02d}{rng.randint(1, 12):02d}"

    for i in range(first, first + count):
        start, end = month(), month()
        if rng.random() < 0.8:
            start, end = min(start, end), max(start, end)
        start = rng.choice([start] * 20 + [None, "200013", "x"])
        pay = rng.choice([0.0, -0.0, 1.5, 7.25, -3.0, 1e-300, 1e300, None, nan, inf, -inf] + [rng.random()] * 9)
        yield rng.choice([None, 1, 2, 3, 4]), rng.choice([None, "a", "b"]), pay, start, end, i


def full_report(spark, rows, metrics):
    df = spark.createDataFrame(rows, PERIOD)
    return [tuple(r) for r in monthly_report(df, None, ROLES, metrics).collect()]


@pytest.mark.parametrize("metrics", [METRICS, METRICS[:1], METRICS[2:3], METRICS[3:]])
def test_loads_equal_the_full_report(spark, tmp_path, metrics):
    rng = random.Random(len(metrics))
    left, state, edges, number = [], None, [], 0
    for load in range(4):
        new = list(periods(rng, 40, 40 * load)) if load < 3 else []
        gone = rng.sample(left, len(left) // 3) if load < 3 else left
        left = [r for r in left if r not in gone] + new
        added = spark.createDataFrame(new, PERIOD) if new else None
        removed = spark.createDataFrame(gone, PERIOD) if gone else None
        made, changes = report_load(state, added, removed, ROLES, metrics)
        number += 1
        edges.append(write_table(made, str(tmp_path / f"e{number}")))
        changes = write_table(changes, str(tmp_path / f"c{number}"))
        state = ReportState(reduce(DataFrame.unionByName, edges), changes)
        found = [tuple(r) for r in report_of(state.changes, metrics).collect()]
        assert repr(found) == repr(full_report(spark, left, metrics) if left else [])
    assert state.changes.isEmpty()


def test_a_load_without_periods_is_refused():
    with pytest.raises(ValueError):
        report_load(None, None)


def test_month_text_of_changes(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "200001", "200003", 0)], PERIOD)
    _, changes = report_load(None, df, None, ROLES)
    months = changes.selectExpr(f"{MONTH_TEXT.format('_month')} AS m").distinct()
    assert sorted(r.m for r in months.collect()) == ["200001", "200004"]


def test_changes_are_made_from_the_stored_edges(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        scans.add(1)
        return x

    made = [(i % 5, str(i % 3), 1.0, "200001", f"20000{1 + i % 9}", i) for i in range(40)]
    rows = spark.createDataFrame(made, PERIOD).withColumn("s", counted.asNondeterministic()("s"))
    state, number = None, 0
    for added, removed in ((rows, None), (None, rows.where("x < 7"))):
        edges, changes = report_load(
            state, added, removed, ROLES, stage=lambda df: write_table(df, str(tmp_path / f"e{number}"))
        )
        state = ReportState(edges, write_table(changes, str(tmp_path / f"c{number}")))
        number += 1
    # Twice for each load: for the edges and for the amounts.
    assert scans.value <= 2 * 2 * 40
    assert [tuple(r) for r in report_of(state.changes).collect()] == full_report(spark, made[7:], METRICS)
