import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanlake.operators.latest import (
    latest_per_key,
    latest_per_key_by_max,
    with_soft_delete,
    with_time,
)
from spanlake.operators.scope import orphans, scope_to_latest, with_snapshot_columns
from spanlake.operators.scope import judge_links
from spanlake.operators.skew import hot_keys, join_salted
from spanlake.plans.catalog import QUERIES

SNAPSHOTS = [
    (1, 11, "a", "2026-01-01 08:00:01.000000"),
    (2, 11, "a", "2026-01-02 08:00:01.000000"),
    (3, 11, "a", "2026-01-02 08:00:01.000000"),
    (4, 12, "b", None),
    (5, 12, "b", "2026-01-01 08:00:01.000000"),
    (6, 13, "c", None),
    (7, 13, "c", None),
    (8, 14, None, "2026-01-01 08:00:01.000000"),
    (9, 15, None, "2026-01-03 08:00:01.000000"),
]
COLUMNS = "ID bigint, NLD_ID bigint, SO_SO_BHXH string, CREATED_AT string"


@pytest.mark.parametrize("pick", [latest_per_key, latest_per_key_by_max])
def test_latest_by_time_then_id_with_nulls_last(spark, pick):
    df = spark.createDataFrame(SNAPSHOTS, COLUMNS)
    kept = pick(df)
    assert kept.columns == df.columns
    assert sorted(r["ID"] for r in kept.collect()) == [3, 5, 7, 9]
    assert kept.count() == df.select("SO_SO_BHXH").distinct().count()


def test_parsed_time_orders_texts_of_different_width(spark):
    rows = [(1, "a", "2026-01-01 9:00:00"), (2, "a", "2026-01-01 10:00:00"), (3, "a", "soon")]
    df = spark.createDataFrame(rows, "ID bigint, SO_SO_BHXH string, CREATED_AT string")
    assert latest_per_key(df).first()["ID"] == 3
    assert latest_per_key(with_time(df), order=["_time", "ID"]).first()["ID"] == 2


def test_latest_sends_one_row_per_key_and_partition(spark):
    df = spark.range(1000).select(
        F.col("id").alias("ID"),
        (F.col("id") % 2).cast("string").alias("SO_SO_BHXH"),
        F.lit("t").alias("CREATED_AT"),
    )
    plan = latest_per_key(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert {r["ID"] for r in latest_per_key(df).collect()} == {998, 999}


def test_soft_delete_columns(spark):
    kept = with_soft_delete(latest_per_key(spark.createDataFrame(SNAPSHOTS, COLUMNS)))
    assert kept.dtypes[-2:] == [("IS_DELETED", "int"), ("DELETED_AT", "timestamp")]
    assert {(r["IS_DELETED"], r["DELETED_AT"]) for r in kept.collect()} == {(0, None)}


PERIODS = [
    (100, 3, 11),
    (101, 3, 99),
    (102, 3, None),
    (103, 1, 11),
    (104, None, 11),
    (105, 5, 12),
    (106, 77, 12),
]
PERIOD_COLUMNS = "ID bigint, MASTER_ID bigint, NLD_ID bigint"


def test_scope_needs_snapshot_and_worker(spark):
    latest = latest_per_key(spark.createDataFrame(SNAPSHOTS, COLUMNS))
    detail = spark.createDataFrame(PERIODS, PERIOD_COLUMNS)
    scoped = scope_to_latest(detail, latest)
    assert scoped.columns == detail.columns
    assert sorted(r["ID"] for r in scoped.collect()) == [100, 105]
    # A repeated snapshot does not repeat its periods.
    assert scope_to_latest(detail, latest.union(latest)).count() == 2


def test_orphans_have_no_snapshot(spark):
    latest = latest_per_key(spark.createDataFrame(SNAPSHOTS, COLUMNS))
    detail = spark.createDataFrame(PERIODS, PERIOD_COLUMNS)
    assert sorted(r["ID"] for r in orphans(detail, latest).collect()) == [103, 104, 106]


def test_person_is_attached_by_snapshot(spark):
    latest = latest_per_key(spark.createDataFrame(SNAPSHOTS, COLUMNS))
    detail = spark.createDataFrame(PERIODS, PERIOD_COLUMNS)
    rows = with_snapshot_columns(detail, latest).collect()
    assert sorted((r["ID"], r["SO_SO_BHXH"]) for r in rows) == [
        (100, "a"),
        (101, "a"),
        (102, "a"),
        (105, "b"),
    ]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a third without key, copies among them."""
    rng = random.Random(7)
    rows = [(7, 1)] * 1500 + [(None, 2)] * 1500
    rows += [(rng.randrange(200), rng.randrange(5)) for _ in range(1500)]
    rng.shuffle(rows)
    left = spark.createDataFrame(rows, "k bigint, v int").repartition(16)
    right_rows = [(k, f"p{k}") for k in range(0, 150)] + [(7, "again"), (None, "none")]
    return rows, right_rows, left, spark.createDataFrame(right_rows, "k bigint, name string")


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("rows_per_salt", [50, 400, 10_000])
def test_salted_join_equals_plain_join(skewed, how, rows_per_salt):
    rows, right_rows, left, right = skewed
    joined = join_salted(left, right, ["k"], how, rows_per_salt)
    assert Counter(map(tuple, joined.collect())) == Counter(
        map(tuple, left.join(right, ["k"], how).collect())
    )
    names = {}
    for k, name in right_rows:
        if k is not None:
            names.setdefault(k, []).append(name)
    expected = {
        "inner": [(k, v, name) for k, v in rows for name in names.get(k, [])],
        "left_semi": [(k, v) for k, v in rows if k in names],
        "left_anti": [(k, v) for k, v in rows if k not in names],
    }[how]
    assert Counter(map(tuple, joined.collect())) == Counter(expected)


def test_only_hot_keys_are_salted(spark, skewed):
    _, _, left, _ = skewed
    hot = hot_keys(left.where("k is not null"), ["k"], 400).collect()
    seven = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert [r["_key"] for r in hot] == [seven]
    assert hot[0]["_salts"] >= 3


def tasks_of_the_hot_key(spark, left, right, key, rows_per_salt):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_salted(left, right, ["k"], "left_semi", rows_per_salt)
        return joined.where(F.col("k") == key).groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_spread_over_tasks(spark):
    rows = spark.range(6000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id AS v")
    known = spark.range(0, 6000, 7).withColumnRenamed("id", "k")
    assert tasks_of_the_hot_key(spark, rows.repartition(16), known, 7, 100) > 3
    # The same in one input partition, and after a shuffle on the key.
    assert tasks_of_the_hot_key(spark, rows.coalesce(1), known, 7, 100) > 3
    assert tasks_of_the_hot_key(spark, rows.repartition(16, "k"), known, 7, 100) > 3


def test_a_key_thin_in_every_partition_is_found(spark):
    """800 rows among a million other keys, a hundred in each partition."""
    rows = spark.range(0, 1_000_000, 1, 8).selectExpr("IF(id % 1250 = 0, -1, id) AS k")
    assert [r["_salts"] for r in hot_keys(rows, ["k"], 300).collect()] == [3]


def test_any_number_of_hot_keys_is_found(spark):
    rows = spark.range(60_000).selectExpr("id % 20000 AS k")
    assert hot_keys(rows, ["k"], 2).count() == 20_000


def test_salting_refuses_what_it_cannot_do(spark, skewed):
    _, _, left, right = skewed
    with pytest.raises(ValueError):
        join_salted(left, right, ["k"], "full")
    with pytest.raises(TypeError):
        join_salted(left, right.withColumn("k", F.col("k").cast("int")), ["k"], "inner")


def shape(df):
    """Operators of the plan before run-time changes, without ids and sizes."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [re.sub(r"[^A-Za-z]+", " ", line).split()[0] for line in plan.splitlines() if line.strip()]


@pytest.mark.parametrize("name", ["scope_to_latest_worker", "detail_with_person", "orphan_periods"])
def test_joins_have_one_plan_at_every_size(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = (
            shape(QUERIES[name](spark, f"/root/testdata/sf{sf}")) for sf in ("0.01", "0.1")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == large


def test_links_are_judged_without_repeating_periods(spark):
    latest = latest_per_key(spark.createDataFrame(SNAPSHOTS, COLUMNS))
    detail = spark.createDataFrame(PERIODS, PERIOD_COLUMNS)
    for known in (latest, latest.union(latest)):
        judged = {r["ID"]: r["_same_worker"] for r in judge_links(detail, known).collect()}
        assert judged == {100: True, 101: False, 102: False, 105: True}
