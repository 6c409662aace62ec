import csv
import os

import pytest
from pyspark.sql import functions as F

from spanlake.__main__ import main
from spanlake.operators import quality as q
from spanlake.plans.jobs import (
    RuleViolation,
    conform,
    ingest,
    present,
    report,
    run_all,
    validate,
)
from spanlake.sources.schemas import period_schema, snapshot_schema
from spanlake.sources.versions import read_current

SNAPSHOTS = [
    # id, worker, person, time
    (1, 11, "p1", "2026-01-01 08:00:01.000000"),
    (2, 11, "p1", "2026-01-02 08:00:01.000000"),
    (3, 12, "p2", "2026-01-01 08:00:01.000000"),
    (4, 12, "p2", "2026-01-01 08:00:01.000000"),
]
PERIODS = [
    # id, snapshot, worker, start, end, employer, pay
    (100, 1, 11, "201901", "201903", "e1", "9.0"),  # not the latest snapshot
    (101, 2, 11, "202001", "202003", "e1", "100.0"),
    (102, 2, 11, " 202003 ", "202003", "e2", "0"),
    (103, 4, 12, "202006", "202006", "e1", "50.5"),
    (104, 4, 99, "202001", "202012", "e1", "1.0"),  # worker of nobody
    (105, 4, 12, "202013", "202101", "e1", "1.0"),  # month 13
    (106, 4, 12, "", "202101", "e1", "1.0"),  # no start
    (107, 4, 12, "202005", "202004", "e1", "1.0"),  # reversed
]
REPORT = [
    ("202001", 1, 1, 100.0, 100.0, 0),
    ("202002", 1, 1, 100.0, 100.0, 0),
    ("202003", 1, 2, 100.0, 100.0, 1),
    ("202004", 0, 0, 0.0, 0.0, 0),
    ("202005", 0, 0, 0.0, 0.0, 0),
    ("202006", 1, 1, 50.5, 50.5, 0),
]


def _write_csv(path, schema, columns, rows):
    with open(path, "w", encoding="utf-8", newline="") as f:
        out = csv.writer(f)
        out.writerow(schema.names)
        for row in rows:
            values = dict(zip(columns, row))
            out.writerow([values.get(name, "") for name in schema.names])


@pytest.fixture
def inputs(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write_csv(
        folder / "snapshots.csv",
        snapshot_schema(),
        ["ID", "NLD_ID", "SO_SO_BHXH", "CREATED_AT"],
        SNAPSHOTS,
    )
    _write_csv(
        folder / "periods.csv",
        period_schema(),
        ["ID", "MASTER_ID", "NLD_ID", "TU_THANG", "DEN_THANG", "MA_DON_VI", "MUC_LUONG"],
        PERIODS,
    )
    return str(folder) + "/"


def lake_table(spark, path):
    return read_current(spark, *path.rsplit("/", 1))


def test_the_four_jobs_end_to_end(spark, inputs, tmp_path, capsys):
    lake = str(tmp_path / "lake")
    for _ in range(2):  # a second run leaves the same lake
        results = run_all(spark, inputs, lake, expected={"snapshots": 4, "periods": 8})
        assert [r.layer for r in results] == ["BRONZE", "SILVER", "GOLD", "VALIDATE"]
        assert {r.status for r in results} == {"SUCCESS"}
        assert results[0].metrics == {"MASTER_ROWS": 4, "DETAIL_ROWS": 8}
        assert results[1].metrics == {
            "MASTER_READ": 4,
            "DETAIL_READ": 8,
            "MASTER_ROWS": 2,
            "DETAIL_SCOPED": 7,
            "DETAIL_ROWS": 3,
            "DETAIL_REJECTED": 3,
            "DETAIL_MISMATCHED": 1,
            "REJECTED[TU_THANG > DEN_THANG]": 1,
            "REJECTED[TU_THANG NULL]": 1,
            "REJECTED[TU_THANG sai format YYYYMM]": 1,
        }
        assert results[2].metrics == {
            "DETAIL_ROWS": 3,
            "FIRST_MONTH": "202001",
            "LAST_MONTH": "202006",
            "MONTHS": 6,
            "MAX_NGUOI_THAM_GIA": 1,
            "SUM_QUY_LUONG_TAT_CA_THANG": 350.5,
            "SUM_NGUOI_LUONG_0": 1,
        }
        assert results[3].metrics["ERROR_ROWS"] == 0
    assert "LAYER=SILVER STATUS=SUCCESS MASTER_READ=4" in capsys.readouterr().out

    bronze = lake_table(spark, f"{lake}/bronze/periods")
    assert len(bronze.columns) == 85 and bronze.columns[-3:] == ["source_file", "load_time", "layer"]
    silver = lake_table(spark, f"{lake}/silver/snapshots")
    assert len(silver.columns) == 55
    assert sorted(r["ID"] for r in silver.collect()) == [2, 4]
    periods = lake_table(spark, f"{lake}/silver/periods")
    assert periods.columns == bronze.columns
    assert sorted((r["ID"], r["TU_THANG"]) for r in periods.collect()) == [
        (101, "202001"),
        (102, "202003"),
        (103, "202006"),
    ]
    rejects = lake_table(spark, f"{lake}/silver/period_rejects")
    assert {r["ID"]: r["REJECT_REASON"] for r in rejects.collect()} == {
        105: "TU_THANG sai format YYYYMM",
        106: "TU_THANG NULL",
        107: "TU_THANG > DEN_THANG",
    }
    monthly = lake_table(spark, f"{lake}/gold/monthly_report")
    assert sorted(map(tuple, monthly.collect())) == REPORT
    shown = present(spark, f"{lake}/gold", str(tmp_path / "shown"))
    assert shown.count() == 6 and shown.first()["Tháng"] == "2020-01"


def test_rejects_of_an_earlier_run_do_not_survive(spark, inputs, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    ingest(spark, inputs, bronze)
    assert conform(spark, bronze, silver).metrics["DETAIL_REJECTED"] == 3
    good = lake_table(spark, f"{bronze}/periods").where("ID <= 103").toPandas()
    _write_csv(
        os.path.join(inputs, "periods.csv"),
        period_schema(),
        ["ID", "MASTER_ID", "NLD_ID", "TU_THANG", "DEN_THANG", "MA_DON_VI", "MUC_LUONG"],
        [p for p in PERIODS if p[0] in set(good["ID"])],
    )
    ingest(spark, inputs, bronze)
    assert conform(spark, bronze, silver).metrics["DETAIL_REJECTED"] == 0
    assert lake_table(spark, f"{silver}/period_rejects").count() == 0


def test_unknown_validity_can_be_dropped(spark, inputs, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    ingest(spark, inputs, bronze)
    result = conform(spark, bronze, silver, keep_unknown=False)
    assert result.metrics["DETAIL_REJECTED"] == 2


def test_every_period_of_a_kept_snapshot_is_counted(spark, inputs, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    ingest(spark, inputs, bronze)
    for keep_unknown in (True, False):
        m = conform(spark, bronze, silver, keep_unknown=keep_unknown).metrics
        fates = ("DETAIL_ROWS", "DETAIL_REJECTED", "DETAIL_MISMATCHED", "DETAIL_UNKNOWN")
        assert m["DETAIL_SCOPED"] == sum(m.get(f, 0) for f in fates) == 7
        assert sum(v for k, v in m.items() if k.startswith("REJECTED[")) == m["DETAIL_REJECTED"]


def test_a_failed_run_leaves_the_last_good_tables(spark, inputs, tmp_path):
    lake = str(tmp_path / "lake")
    run_all(spark, inputs, lake)
    before = sorted(map(tuple, lake_table(spark, f"{lake}/bronze/periods").collect()))
    with pytest.raises(RuleViolation):
        ingest(spark, inputs, f"{lake}/bronze", expected={"periods": 9})
    assert sorted(map(tuple, lake_table(spark, f"{lake}/bronze/periods").collect())) == before
    schema = lake_table(spark, f"{lake}/silver/periods").schema
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "bare/periods"))
    lake_table(spark, f"{lake}/silver/snapshots").write.parquet(str(tmp_path / "bare/snapshots"))
    with pytest.raises(RuleViolation, match="empty month axis"):
        report(spark, str(tmp_path / "bare"), f"{lake}/gold")
    assert lake_table(spark, f"{lake}/gold/monthly_report").count() == 6


def test_options_reach_the_scan(spark, inputs, tmp_path):
    bronze = str(tmp_path / "bronze")
    with open(os.path.join(inputs, "periods.csv"), "a", encoding="utf-8") as f:
        f.write("x,y,z\n")
    result = ingest(spark, inputs, bronze, corrupt_column="_broken", multi_line=True)
    assert result.metrics["DETAIL_CORRUPT"] == 1 and result.metrics["MASTER_CORRUPT"] == 0
    with open(os.path.join(inputs, "snapshots.csv"), "a", encoding="utf-8") as f:
        f.write(",,,\n")
    with pytest.raises(RuleViolation, match="NULL ID"):
        ingest(spark, inputs, bronze, required=True)


def test_unexpected_row_count_stops_the_run(spark, inputs, tmp_path):
    with pytest.raises(RuleViolation, match="snapshots: expected rows"):
        run_all(spark, inputs, str(tmp_path / "lake"), expected={"snapshots": 5})
    assert not os.path.exists(tmp_path / "lake" / "silver")


def test_no_valid_month_stops_the_report(spark, inputs, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    ingest(spark, inputs, bronze)
    conform(spark, bronze, silver)
    bare = str(tmp_path / "bare")
    schema = lake_table(spark, f"{silver}/periods").schema
    spark.createDataFrame([], schema).write.parquet(f"{bare}/periods")
    lake_table(spark, f"{silver}/snapshots").write.parquet(f"{bare}/snapshots")
    with pytest.raises(RuleViolation, match="empty month axis"):
        report(spark, bare, str(tmp_path / "gold"))
    assert not os.listdir(tmp_path / "gold" / "versions")


LATEST = "ID bigint, NLD_ID bigint, SO_SO_BHXH string"
DETAIL = "MASTER_ID bigint, NLD_ID bigint, TU_THANG string, DEN_THANG string"
GOOD_LATEST = [(1, 11, "a"), (2, 12, "b")]
GOOD_DETAIL = [(1, 11, "202001", "202002"), (2, 12, "202001", "202001")]
GOOD_REPORT = [("202001", 1.0), ("202002", 0.0)]


def _lake(spark, lake, latest=GOOD_LATEST, detail=GOOD_DETAIL, months=GOOD_REPORT):
    for path, rows, columns in (
        ("silver/snapshots", latest, LATEST),
        ("silver/periods", detail, DETAIL),
        ("gold/monthly_report", months, "THANG_ID string, TONG_QUY_LUONG double"),
    ):
        spark.createDataFrame(rows, columns).write.mode("overwrite").parquet(f"{lake}/{path}")


@pytest.mark.parametrize(
    "broken, rule, count",
    [
        ({"detail": GOOD_DETAIL + [(9, 11, "202001", "202001")] * 2}, "orphan periods", 2),
        ({"detail": GOOD_DETAIL + [(None, 11, "202001", "202001")]}, "orphan periods", 1),
        ({"latest": GOOD_LATEST + [(3, 11, "a")]}, "persons with several snapshots", 1),
        ({"detail": GOOD_DETAIL + [(1, 11, "202003", "202001")]}, "reversed periods", 1),
        ({"detail": GOOD_DETAIL + [(1, 11, None, "202001")]}, "malformed periods", 1),
        ({"months": GOOD_REPORT + [("202001", 2.0)]}, "duplicate months", 1),
    ],
)
def test_validate_names_exactly_the_broken_rule(spark, tmp_path, broken, rule, count):
    lake = str(tmp_path / "lake")
    _lake(spark, lake)
    assert validate(spark, lake).violated == {}
    _lake(spark, lake, **broken)
    with pytest.raises(RuleViolation) as failure:
        validate(spark, lake)
    assert f"ERROR_ROWS={count} " in str(failure.value)
    assert str({rule: count}) in str(failure.value)


def _count(rule):
    return rule.first()["violations"]


def test_rules_that_run_inside_the_jobs(spark):
    latest = spark.createDataFrame(GOOD_LATEST, LATEST)
    detail = spark.createDataFrame(
        GOOD_DETAIL + [(1, 99, "202001", "202001"), (2, None, "202001", "202001")], DETAIL
    )
    months = spark.createDataFrame(GOOD_REPORT + [("202003", -1.0)], "THANG_ID string, TONG_QUY_LUONG double")
    assert _count(q.link_mismatches(detail, latest)) == 2
    assert _count(q.negative_totals(months)) == 1
    assert _count(q.missing_months(months.where("TONG_QUY_LUONG >= 0"), months)) == 1
    assert _count(q.empty_axis(months)) == 0
    assert _count(q.empty_axis(months.where("false"))) == 1
    assert _count(q.null_keys(detail, "NLD_ID")) == 1
    assert _count(q.not_a_number(months.withColumn("x", F.lit(float("nan"))), "x")) == 3
    snapshots = latest.union(spark.createDataFrame([(5, 1, None), (6, 1, None)], LATEST))
    assert _count(q.latest_parity(snapshots, latest)) == 1
    assert _count(q.latest_parity(latest.where("false"), latest.where("false"))) == 0
    assert _count(q.row_difference(spark, "r", 3, 5)) == 2


def test_status_follows_the_rules(spark):
    metrics = spark.sql("SELECT 'MASTER_ROWS' AS metric, 2L AS value")
    good = q.row_difference(spark, "r", 1, 1)
    bad = q.violations(good, q.row_difference(spark, "s", 1, 2))
    assert q.layer_status("X", metrics, good).first()["status"] == "SUCCESS"
    assert q.layer_status("X", metrics, bad).first()["status"] == "FAILED"
    assert q.total_violations(bad).first()["ERROR_ROWS"] == 1


def test_shell_entry_returns_the_exit_code(spark, inputs, tmp_path):
    lake = str(tmp_path / "lake")
    zone = spark.conf.get("spark.sql.session.timeZone")
    level = ["run-all", "--input-dir", inputs, "--output-dir", lake]
    try:
        assert main([*level, "--expected-periods", "8"]) == 0
        shown = ["--input-dir", f"{lake}/gold", "--output-dir", lake, "--presented-folder", "shown"]
        assert main(["present", *shown]) == 0 and os.path.isdir(f"{lake}/shown")
        options = ["--multi-line", "--corrupt-column", "_bad", "--required", "--drop-unknown"]
        folders = ["--rejects-folder", "refused", "--parse-time"]
        assert main([*level, *options, *folders]) == 0
        assert lake_table(spark, f"{lake}/silver/refused").count() == 2
        assert "_bad" in lake_table(spark, f"{lake}/bronze/periods").columns
        assert main(["validate", "--lake-dir", lake]) == 0
        assert main([*level, "--expected-periods", "9"]) == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
