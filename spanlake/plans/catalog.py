"""The registered queries: every operator on the test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.operators import quality as q
from spanlake.operators.fusion import fused, lake_rules
from spanlake.operators.incremental import (
    ReportState,
    latest_changes,
    latest_merge,
    report_load,
    report_of,
)
from spanlake.operators.intervals import expand, month_bounds, month_dim, range_join
from spanlake.operators.latest import latest_per_key, latest_per_key_by_max, with_soft_delete
from spanlake.operators.report import (
    METRICS,
    clustered,
    fill_gaps,
    finish,
    monthly_report,
    monthly_values,
    present,
    report_by_expansion,
    report_by_range_join,
    report_for_months,
    report_summary,
)
from spanlake.operators.scope import (
    judge_links,
    orphans,
    scope_to_latest,
    slim,
    with_snapshot_columns,
)
from spanlake.operators.split import (
    clean_periods,
    is_valid,
    reject_reason_counts,
    rejected_periods,
    valid_periods,
    well_formed,
)
from spanlake.plans.mapping import (
    ROLES,
    every_period,
    latest,
    messy,
    periods,
    scoped,
    snapshots,
    table,
)
from spanlake.session import scratch_path
from spanlake.sources.files import (
    BAD_CELLS,
    CSV_DIALECT,
    quarantine,
    read_csv,
    read_csv_cells,
    read_table,
    row_count,
    with_load_columns,
    write_observed,
    write_table,
)
from spanlake.sources.records import read_csv_records

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

START, END = ROLES.start, ROLES.end
LINK = {"master_id": "id"}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


def rounded(report: DataFrame) -> DataFrame:
    """Report with the amounts at the decimals of the prices, to be compared across engines.

    The report adds the doubles as they are; SQL adds the prices as decimals.
    """
    places = {n.PAYROLL: 2, n.MEAN_PAY: 4}
    return report.withColumns({c: F.round(c, d) for c, d in places.items() if c in report.columns})


def staged(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared scratch folder, for plans that use them several times."""
    return write_table(df, scratch_path(df.sparkSession, "staged"))


# Scans and sinks


@query("scan_parquet")
def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def _as_csv(df: DataFrame) -> str:
    """Path of the table written as CSV files of the input dialect."""
    path = scratch_path(df.sparkSession, "csv")
    dialect = {k: v for k, v in CSV_DIALECT.items() if k != "mode"}
    df.write.options(
        **dialect, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return path


def _through_csv(df: DataFrame, multi_line: bool) -> DataFrame:
    """The table written as CSV files of the input dialect and read under its schema."""
    return read_csv(df.sparkSession, _as_csv(df), df.schema, multi_line)


@query("csv_ingest")
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    events = table(spark, sf_dir, "events").withColumn("ts", as_text)
    return _through_csv(events, multi_line=False)


@query("csv_ingest_multi_line")
def csv_ingest_multi_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(table(spark, sf_dir, "documents"), multi_line=True)


@query("csv_records")
def csv_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose texts got line breaks and quotes, from files that many tasks read each."""
    docs = table(spark, sf_dir, "documents")
    text = F.concat(F.regexp_replace("text", "([.,]) ", '$1\n"'), F.lit('"\n\n'))
    broken = docs.withColumn("text", text)
    return read_csv_records(spark, _as_csv(broken), broken.schema)


@query("csv_quarantine")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items whose CSV has cells that do not fit, with their fields and texts."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag"
    )
    line = F.col("l_linenumber")
    broken = lines.withColumns(
        {
            "l_quantity": F.when(line % 3 == 0, "n/a").otherwise(F.col("l_quantity").cast("string")),
            "l_extendedprice": F.when(line == 2, " ").otherwise(F.col("l_extendedprice").cast("string")),
            "l_shipdate": F.when(line >= 6, 'a "day", or so').otherwise(F.col("l_shipdate").cast("string")),
        }
    )
    path = _as_csv(broken)
    _, refused = quarantine(read_csv_cells(spark, path, lines.schema))
    shown = F.transform(BAD_CELLS, lambda x: F.concat(x["field"], F.lit("="), x["text"]))
    return refused.select(
        "l_orderkey",
        "l_linenumber",
        F.array_join(shown, ";").alias("bad_cells"),
        F.coalesce("l_quantity", F.lit(-1)).cast("double").alias("quantity"),
        F.col("l_shipdate").isNull().alias("no_date"),
    )


@query("bronze_metadata")
def bronze_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = with_load_columns(table(spark, sf_dir, "orders"), "orders.csv")
    return loaded.withColumn(n.LOAD_TIME, F.col(n.LOAD_TIME).isNotNull())


@query("write_recount")
def write_recount(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, written = write_observed(table(spark, sf_dir, "lineitem"), scratch_path(spark, "recount"))
    counts = {"sent": sent, "written": written}
    return spark.range(1).select(*[F.lit(v).cast("long").alias(c) for c, v in counts.items()])


@query("reject_sink")
def reject_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = rejected_periods(clean_periods(messy(spark, sf_dir), START, END, "salary"), START, END)
    return write_table(rejects, scratch_path(spark, "rejects"))


# Projections and snapshots


@query("slim_project")
def slim_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slim(table(spark, sf_dir, "orders"), {"o_orderkey": "id", "o_custkey": "person"})


@query("soft_delete_columns")
def soft_delete_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_soft_delete(latest(spark, sf_dir))


@query("clean_months")
def clean_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_periods(messy(spark, sf_dir), START, END, "salary")


@query("distinct_persons")
def distinct_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = F.nullif(F.col("person") % 1000, F.lit(0)).alias("person")
    return row_count(snapshots(spark, sf_dir).select(person).distinct())


@query("latest_per_key")
def latest_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir)


def _with_ties_and_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots with ties in time and with missing persons and times."""
    return snapshots(spark, sf_dir).select(
        "id",
        F.nullif(F.col("person") % 1000, F.lit(0)).alias("person"),
        F.when(F.col("id") % 11 != 0, F.date_trunc("year", "created")).alias("created"),
    )


@query("latest_per_key_with_ties")
def latest_per_key_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_ties_and_nulls(spark, sf_dir)
    return latest_per_key(rows, ["person"], ["created", "id"])


@query("latest_per_key_max")
def latest_per_key_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_ties_and_nulls(spark, sf_dir)
    return latest_per_key_by_max(rows, ["person"], ["created", "id"])


def _loads(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Snapshots with ties and missing values in three loads, none of which is older than another."""
    rows = _with_ties_and_nulls(spark, sf_dir)
    return [rows.where(F.col("id") % 3 == i) for i in range(3)]


def _merged(spark: SparkSession, sf_dir: str, loads: int) -> DataFrame:
    """The snapshot table after so many loads; load ``i`` comes on day ``i``."""
    table = None
    for i, load in enumerate(_loads(spark, sf_dir)[:loads]):
        at = F.make_date(F.lit(2020), F.lit(1), F.lit(i + 1)).cast("timestamp")
        table = staged(latest_merge(table, load, at, ["person"], ["created", "id"]))
    return table


@query("latest_merge")
def latest_after_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir, 3)


@query("latest_changes")
def changes_of_a_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys the third load is new for, replaces, comes late for, or leaves untouched."""
    load = _loads(spark, sf_dir)[2]
    found = latest_changes(_merged(spark, sf_dir, 2), load, ["person"], ["created", "id"])
    return found.groupBy("change").agg(F.count(F.lit(1)).alias("rows"))


# Linking


@query("scope_to_latest")
def scope_to_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope_to_latest(periods(spark, sf_dir), latest(spark, sf_dir), LINK)


def _with_workers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Periods with the supplier's nation and latest snapshots with the customer's."""
    suppliers = slim(
        table(spark, sf_dir, "supplier"), {"s_suppkey": "employer", "s_nationkey": "worker"}
    )
    customers = slim(
        table(spark, sf_dir, "customer"), {"c_custkey": "person", "c_nationkey": "worker"}
    )
    return (
        periods(spark, sf_dir).join(suppliers, "employer"),
        latest(spark, sf_dir).join(customers, "person"),
    )


@query("scope_to_latest_worker")
def scope_to_latest_worker(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail, known = _with_workers(spark, sf_dir)
    return scope_to_latest(detail, known, {"master_id": "id", "worker": "worker"})


def _with_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of which those of the first three lines all belong to one latest snapshot."""
    hot = latest(spark, sf_dir).agg(F.min("id")).scalar()
    link = F.when(F.col("line") <= 3, hot).otherwise(F.col("master_id"))
    return periods(spark, sf_dir).withColumn("master_id", link)


SALTED = {"rows_per_salt": 1_000}


@query("scope_to_latest_salted")
def scope_to_latest_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope_to_latest(
        _with_hot_key(spark, sf_dir), latest(spark, sf_dir), LINK, **SALTED
    )


@query("scope_conservation")
def scope_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of the periods of kept snapshots: their numbers add up to all of them."""
    detail, known = _with_workers(spark, sf_dir)
    detail = detail.withColumns({START: F.col("to_month"), END: F.lit("199506")})
    linked = judge_links(detail, known, "master_id", "worker", "id", "worker")
    same, good = F.col("_same_worker"), is_valid(START, END)
    return linked.agg(
        F.count(F.lit(1)).alias("scoped"),
        F.count_if(same & good).alias("valid"),
        F.count_if(same & ~good).alias("rejected"),
        F.count_if(~same).alias("mismatched"),
    )


@query("detail_with_person")
def detail_with_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoped(spark, sf_dir)


@query("detail_with_person_salted")
def detail_with_person_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_snapshot_columns(
        _with_hot_key(spark, sf_dir),
        latest(spark, sf_dir),
        ["person", "from_month"],
        "master_id",
        "id",
        **SALTED,
    )


@query("orphan_periods")
def orphan_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans(periods(spark, sf_dir), latest(spark, sf_dir), "master_id", "id")


@query("orphan_periods_salted")
def orphan_periods_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    link = F.when(F.col("line") > 3, F.col("master_id"))
    unlinked = periods(spark, sf_dir).withColumn("master_id", link)
    return orphans(unlinked, latest(spark, sf_dir), "master_id", "id", **SALTED)


# Split


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_periods(messy(spark, sf_dir), START, END, "salary")


@query("month_format_filter")
def month_format_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messy(spark, sf_dir).where(well_formed(START, END))


@query("valid_intervals")
def valid_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_periods(_clean(spark, sf_dir), START, END)


@query("reject_reasons")
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_periods(_clean(spark, sf_dir), START, END)


@query("reject_reasons_known")
def reject_reasons_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejected_periods(_clean(spark, sf_dir), START, END, unknown=False)


@query("reject_reason_counts")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_reason_counts(rejected_periods(_clean(spark, sf_dir), START, END))


@query("split_conservation")
def split_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = is_valid(START, END)
    return _clean(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("rejected"),
    )


# Months


@query("month_bounds")
def scoped_month_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_bounds(valid_periods(scoped(spark, sf_dir), START, END), START, END)


def _axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_dim(valid_periods(scoped(spark, sf_dir), START, END), START, END)


@query("month_dim")
def month_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _axis(spark, sf_dir)


@query("month_dim_empty")
def month_dim_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = messy(spark, sf_dir).withColumn(END, F.concat(F.lit("x"), END))
    return row_count(month_dim(broken, START, END))


@query("interval_month_join")
def interval_month_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scoped(spark, sf_dir).select("master_id", "line", START, END)
    return range_join(rows, _axis(spark, sf_dir), START, END)


@query("interval_month_explode")
def interval_month_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expand(scoped(spark, sf_dir).select("master_id", "line", START, END), START, END)


# Report


def _report(spark: SparkSession, sf_dir: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    return rounded(monthly_report(scoped(spark, sf_dir), None, ROLES, metrics))


@query("monthly_report")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


@query("monthly_report_given_axis")
def monthly_report_given_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Axis of all periods, so the months before and after the scoped ones are gaps."""
    dim = month_dim(every_period(spark, sf_dir), START, END)
    return rounded(monthly_report(scoped(spark, sf_dir), dim, ROLES))


@query("monthly_report_explode")
def monthly_report_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(valid_periods(scoped(spark, sf_dir), START, END))
    return rounded(report_by_expansion(staged(month_dim(rows, START, END)), rows, ROLES))


@query("monthly_report_range_join")
def monthly_report_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged(valid_periods(scoped(spark, sf_dir), START, END))
    return rounded(report_by_range_join(staged(month_dim(rows, START, END)), rows, ROLES))


@query("monthly_report_every_period")
def monthly_report_every_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(monthly_report(every_period(spark, sf_dir), None, ROLES))


@query("monthly_report_range")
def monthly_report_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three years of the report of every period, from files clustered by end month."""
    rows = staged(clustered(every_period(spark, sf_dir), END, START))
    return rounded(report_for_months(rows, "199511", "199810", ROLES))


@query("monthly_report_incremental")
def monthly_report_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report after three loads: some periods, more of the same people, and some taken away again."""
    rows = staged(every_period(spark, sf_dir))
    line = F.col("line")
    loads = [
        (rows.where(line <= 3), None),
        (rows.where(line > 3), rows.where(line == 1)),
        (None, rows.where(line == 7)),
    ]
    state, edges = None, []
    for added, removed in loads:
        new, changes = report_load(state, added, removed, ROLES, stage=staged)
        edges.append(new)
        state = ReportState(reduce(DataFrame.unionByName, edges), staged(changes))
    return rounded(report_of(state.changes))


def _scaled(report: DataFrame, scale: float) -> DataFrame:
    """Amounts over ``scale`` at four decimals, to be compared across engines."""
    return report.withColumns(
        {c: F.round(F.col(c) / scale, 4) for c in (n.PAYROLL, n.MEAN_PAY)}
    )


@query("monthly_report_fine_amounts")
def monthly_report_fine_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salaries with all the digits that a double has."""
    return _scaled(monthly_report(scoped(spark, sf_dir, F.col("salary") / 7.3), None, ROLES), 1.0)


@query("monthly_report_large_amounts")
def monthly_report_large_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Salaries beyond the integers that a decimal holds."""
    return _scaled(monthly_report(scoped(spark, sf_dir, F.col("salary") * 1e20 / 7.3), None, ROLES), 1e20)


@query("gap_fill_left_join")
def gap_fill_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoped periods on the axis of all periods: the months before and after them are gaps."""
    rows = expand(scoped(spark, sf_dir), START, END)
    monthly = finish(monthly_values(rows, ROLES), n.MONTH)
    return rounded(fill_gaps(month_dim(every_period(spark, sf_dir), START, END), monthly))


def _single_metric(name: str, metric: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: _report(spark, sf_dir, (metric,))


_single_metric("monthly_participants", n.PEOPLE)
_single_metric("monthly_employers", n.EMPLOYERS)
_single_metric("monthly_payroll", n.PAYROLL)
_single_metric("monthly_avg_positive", n.MEAN_PAY)
_single_metric("monthly_zero_pay_people", n.ZERO_PAY_PEOPLE)


@query("report_summary")
def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = (n.PEOPLE, n.PAYROLL, n.ZERO_PAY_PEOPLE)
    totals = report_summary(_report(spark, sf_dir, wanted))
    return totals.withColumn(n.PAYROLL_OF_ALL_MONTHS, F.round(n.PAYROLL_OF_ALL_MONTHS, 2))


@query("report_presentation")
def report_presentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(_report(spark, sf_dir))


# Rules


@query("layer_counts")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of snapshots and periods, from the footers."""
    counts = [
        row_count(table(spark, sf_dir, name)).select(F.lit(name).alias("table"), "rows")
        for name in ("orders", "lineitem")
    ]
    return counts[0].unionByName(counts[1])


@query("dq_duplicate_keys")
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_keys("duplicate lines", periods(spark, sf_dir), ["master_id", "line"])


@query("dq_latest_parity")
def dq_latest_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_ties_and_nulls(spark, sf_dir)
    kept = latest_per_key(rows, ["person"], ["created", "id"])
    return q.latest_parity(rows, kept, "person")


@query("dq_latest_parity_broken")
def dq_latest_parity_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the kept rows is lost."""
    rows = _with_ties_and_nulls(spark, sf_dir)
    kept = latest_per_key(rows, ["person"], ["created", "id"]).where("id % 5 <> 0")
    return q.latest_parity(rows, kept, "person")


@query("dq_written_rows")
def dq_written_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, written = write_observed(periods(spark, sf_dir), scratch_path(spark, "written"))
    return q.row_difference(spark, "periods: written rows", written, sent)


@query("dq_written_rows_lost")
def dq_written_rows_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folder has lost the rows of the last line when it is counted."""
    path = scratch_path(spark, "lost")
    rows = periods(spark, sf_dir)
    sent, _ = write_observed(rows, path)
    found = write_table(read_table(spark, path).where("line < 7"), scratch_path(spark, "found")).count()
    return q.row_difference(spark, "periods: written rows", found, sent)


@query("dq_expected_rows")
def dq_expected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven periods are expected of every snapshot."""
    _, written = write_observed(periods(spark, sf_dir), scratch_path(spark, "expected"))
    expected = 7 * snapshots(spark, sf_dir).count()
    return q.row_difference(spark, "periods: expected rows", written, expected)


@query("dq_empty_axis")
def dq_empty_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.empty_axis(_axis(spark, sf_dir))


@query("dq_empty_axis_broken")
def dq_empty_axis_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = scoped(spark, sf_dir).withColumn(END, F.concat(F.lit("x"), END))
    return q.empty_axis(month_dim(broken, START, END))


@query("dq_orphans")
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.orphan_rows(periods(spark, sf_dir), latest(spark, sf_dir), "master_id", "id")


@query("dq_link_mismatch")
def dq_link_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    detail, known = _with_workers(spark, sf_dir)
    return q.link_mismatches(detail, known, "master_id", "id", "worker", "worker")


@query("dq_interval_order")
def dq_interval_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.reversed_periods(scoped(spark, sf_dir), START, END)


@query("dq_malformed_months")
def dq_malformed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.malformed_periods(_clean(spark, sf_dir), START, END)


@query("dq_null_keys")
def dq_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.null_keys(_with_ties_and_nulls(spark, sf_dir), "person")


@query("dq_nan_amounts")
def dq_nan_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pay = F.when(F.col("line") == 7, float("nan")).otherwise(F.col("salary"))
    return q.not_a_number(periods(spark, sf_dir).withColumn("salary", pay), "salary")


@query("dq_report_complete")
def dq_report_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.missing_months(_axis(spark, sf_dir), _report(spark, sf_dir))


@query("dq_report_incomplete")
def dq_report_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report has lost its Junes."""
    report = _report(spark, sf_dir, (n.PEOPLE,)).where(~F.col(n.MONTH).endswith("06"))
    return q.missing_months(_axis(spark, sf_dir), report)


@query("dq_duplicate_months")
def dq_duplicate_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.duplicate_months(periods(spark, sf_dir).withColumnRenamed(END, n.MONTH))


@query("dq_negative_total")
def dq_negative_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months by shipping day, so that some of the signed totals fall below zero."""
    sign = F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(-1)
    lines = table(spark, sf_dir, "lineitem").withColumn(n.MONTH, F.to_date("l_shipdate"))
    totals = lines.groupBy(n.MONTH).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)") * sign).cast("double").alias(n.PAYROLL)
    )
    return q.negative_totals(totals)


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of the validating job on snapshots, periods, scoped periods and report."""
    kept, rows = latest(spark, sf_dir), scoped(spark, sf_dir).select("person", START, END)
    report = monthly_report(rows, None, ROLES, (n.PEOPLE,))
    return fused(
        {"kept": kept, "periods": periods(spark, sf_dir), "rows": rows, "report": report},
        lake_rules(
            "kept", "periods", "report", "id", "master_id", "person", START, END, "rows", malformed=False
        ),
    )


@query("validate_rules")
def validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir)


@query("validate_summary")
def validate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.total_violations(_rules(spark, sf_dir))


@query("layer_status")
def layer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = latest(spark, sf_dir)
    metrics = [
        row_count(rows).select(F.lit(metric).alias("metric"), F.col("rows").alias("value"))
        for metric, rows in (("MASTER_ROWS", kept), ("DETAIL_ROWS", scoped(spark, sf_dir)))
    ]
    rules = q.violations(
        q.duplicate_keys("persons with several snapshots", kept, ["person"]),
        q.orphan_rows(scoped(spark, sf_dir), kept, "master_id", "id"),
    )
    return q.layer_status("SILVER", metrics[0].unionByName(metrics[1]), rules)


@query("layer_status_failed")
def layer_status_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unscoped periods break the rule on orphans."""
    kept, rows = latest(spark, sf_dir), periods(spark, sf_dir)
    metrics = row_count(rows).select(F.lit("DETAIL_ROWS").alias("metric"), F.col("rows").alias("value"))
    return q.layer_status("SILVER", metrics, q.orphan_rows(rows, kept, "master_id", "id"))
