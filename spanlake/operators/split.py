"""Cleaning of period rows and their split into valid rows and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.functions.months import is_month


def clean_periods(
    df: DataFrame, start: str = n.START, end: str = n.END, salary: str | None = n.SALARY
) -> DataFrame:
    """Trim both months and read the salary as double (NULL when it is no number)."""
    changed = {start: F.trim(start), end: F.trim(end)}
    if salary is not None:
        changed[salary] = F.col(salary).try_cast("double")
    return df.withColumns(changed)


def well_formed(start: str = n.START, end: str = n.END) -> Column:
    """Both months are well-formed; NULL or false otherwise."""
    return is_month(start) & is_month(end)


def in_order(start: str = n.START, end: str = n.END) -> Column:
    """Start is not after end; text order equals time order for well-formed months."""
    return F.col(start) <= F.col(end)


def is_valid(start: str = n.START, end: str = n.END) -> Column:
    """Total predicate: never NULL, so that it and its negation cover every row."""
    return F.coalesce(well_formed(start, end) & in_order(start, end), F.lit(False))


def unknown_validity(start: str = n.START, end: str = n.END) -> Column:
    """A month is NULL and the other one does not already refute the row."""
    return (well_formed(start, end) & in_order(start, end)).isNull()


def reject_reason(start: str = n.START, end: str = n.END, unknown: bool = True) -> Column:
    """First reason why a row is not valid.

    The three texts for malformed and reversed months are fixed values; with ``unknown`` a
    missing month has its own text.
    """
    reason = F.when(F.col(start).isNull(), f"{start} NULL") if unknown else F
    reason = reason.when(~is_month(start), f"{start} sai format YYYYMM")
    if unknown:
        reason = reason.when(F.col(end).isNull(), f"{end} NULL")
    return reason.when(~is_month(end), f"{end} sai format YYYYMM").otherwise(f"{start} > {end}")


def valid_periods(df: DataFrame, start: str = n.START, end: str = n.END) -> DataFrame:
    return df.where(is_valid(start, end))


def rejected_periods(
    df: DataFrame, start: str = n.START, end: str = n.END, unknown: bool = True
) -> DataFrame:
    """Rows that are not valid, with the reason.

    ``unknown=False`` leaves out rows whose validity SQL cannot decide because a month is NULL
    and the rest does not already refute it.
    """
    if unknown:
        bad = df.where(~is_valid(start, end))
    else:
        bad = df.where(~(well_formed(start, end) & in_order(start, end)))
    return bad.withColumn(n.REJECT_REASON, reject_reason(start, end, unknown))


def reject_reason_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(n.REJECT_REASON).agg(F.count(F.lit(1)).alias("rows"))
