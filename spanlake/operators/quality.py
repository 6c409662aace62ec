"""Data-quality rules: each is a one-row table of a rule's name and its number of violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.operators.scope import slim
from spanlake.operators.split import well_formed


def _rule(rule: str, counted: DataFrame) -> DataFrame:
    """Name a one-column, one-row count."""
    count = F.coalesce(F.col(counted.columns[0]).cast("bigint"), F.lit(0).cast("bigint"))
    return counted.select(F.lit(rule).alias("rule"), count.alias("violations"))


def rows_where(rule: str, df: DataFrame, violated: Column) -> DataFrame:
    """Rows for which the condition holds."""
    return _rule(rule, df.agg(F.count_if(violated)))


def duplicate_keys(rule: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row; NULL counts as a key."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return _rule(rule, per_key.where("_rows > 1").agg(F.count(F.lit(1))))


def unlinked_rows(
    rule: str, df: DataFrame, known: DataFrame, links: dict[str, str]
) -> DataFrame:
    """Rows whose linking columns are NULL or match no known row.

    Rows are counted per link before the anti-join, so a frequent link is one row by then.
    """
    per_link = df.groupBy(*links).agg(F.count(F.lit(1)).alias("_rows"))
    side = slim(known, {there: here for here, there in links.items()}).distinct()
    return _rule(rule, per_link.join(side, list(links), "left_anti").agg(F.sum("_rows")))


def orphan_rows(
    detail: DataFrame,
    latest: DataFrame,
    master_id: str = n.MASTER_ID,
    snapshot_id: str = n.ID,
) -> DataFrame:
    return unlinked_rows("orphan periods", detail, latest, {master_id: snapshot_id})


def link_mismatches(
    detail: DataFrame,
    latest: DataFrame,
    master_id: str = n.MASTER_ID,
    snapshot_id: str = n.ID,
    detail_worker: str = n.WORKER,
    snapshot_worker: str = n.WORKER,
) -> DataFrame:
    """Periods of a kept snapshot whose worker id is not that snapshot's."""
    per_link = detail.groupBy(master_id, detail_worker).agg(F.count(F.lit(1)).alias("_rows"))
    snapshots = slim(latest, {snapshot_id: master_id, snapshot_worker: "_worker"}).distinct()
    known = per_link.join(snapshots.select(master_id).distinct(), master_id, "left_semi")
    both = snapshots.withColumnRenamed("_worker", detail_worker)
    missed = known.join(both, [master_id, detail_worker], "left_anti")
    return _rule("worker id mismatches", missed.agg(F.sum("_rows")))


def reversed_periods(
    detail: DataFrame, start: str = n.START, end: str = n.END
) -> DataFrame:
    return rows_where("reversed periods", detail, F.col(start) > F.col(end))


def malformed_periods(
    detail: DataFrame, start: str = n.START, end: str = n.END
) -> DataFrame:
    """Missing or malformed months."""
    bad = ~F.coalesce(well_formed(start, end), F.lit(False))
    return rows_where("malformed periods", detail, bad)


def latest_parity(
    snapshots: DataFrame, latest: DataFrame, key: str = n.PERSON
) -> DataFrame:
    """Difference between the kept rows and the distinct keys; NULL is one key."""
    null_key = F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    keys = snapshots.agg(F.count_distinct(key) + null_key)
    return _difference("latest rows differ from distinct keys", latest, keys)


INCOMPLETE = "report months differ from axis"


def missing_months(dim: DataFrame, report: DataFrame) -> DataFrame:
    """Difference between the rows of the report and the months of the axis."""
    return _difference(INCOMPLETE, report, dim.agg(F.count(F.lit(1))))


def _difference(rule: str, rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Difference between a number of rows and an expected one-row count."""
    return _rule(rule, rows.agg(F.abs(F.count(F.lit(1)) - expected.scalar())))


def empty_axis(dim: DataFrame) -> DataFrame:
    no_month = (F.count(F.lit(1)) == 0).cast("bigint")
    return _rule("empty month axis", dim.agg(no_month))


def duplicate_months(report: DataFrame) -> DataFrame:
    return duplicate_keys("duplicate months", report, [n.MONTH])


def negative_totals(report: DataFrame) -> DataFrame:
    return rows_where("negative payrolls", report, F.col(n.PAYROLL) < 0)


def not_a_number(df: DataFrame, column: str) -> DataFrame:
    return rows_where("NaN amounts", df, F.isnan(column))


def null_keys(df: DataFrame, column: str) -> DataFrame:
    """Missing values of a column the schema calls required; file reads do not enforce it."""
    return rows_where(f"NULL {column}", df, F.col(column).isNull())


def row_difference(spark: SparkSession, rule: str, actual: int, expected: int) -> DataFrame:
    """Difference of two row counts that are already known, as a rule."""
    return _rule(rule, spark.range(1).select(F.lit(abs(actual - expected))))


def violations(*rules: DataFrame) -> DataFrame:
    """All rules below each other: one row per rule."""
    return reduce(DataFrame.unionByName, rules)


def total_violations(rules: DataFrame) -> DataFrame:
    return rules.agg(F.sum("violations").alias("ERROR_ROWS"))


def layer_status(layer: str, metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metrics of a layer (``metric``, ``value``) with the status that its rules give it."""
    failed = rules.agg(F.coalesce(F.sum("violations"), F.lit(0)) > 0)
    status = F.when(failed.scalar(), "FAILED").otherwise("SUCCESS")
    return metrics.select(F.lit(layer).alias("layer"), status.alias("status"), "metric", "value")
