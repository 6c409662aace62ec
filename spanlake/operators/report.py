"""Five metrics per month, gap filling, summary and presentation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.functions.amounts import band, is_finite, quoted, total, units
from spanlake.functions.months import MONTH_PATTERN, MONTH_TEXT, month_label, whole_number
from spanlake.operators.intervals import Roles, accumulate, expand, range_join, sweep
from spanlake.operators.split import is_valid

METRICS = (n.PEOPLE, n.EMPLOYERS, n.PAYROLL, n.MEAN_PAY, n.ZERO_PAY_PEOPLE)

HEADS = {n.PEOPLE: "people", n.EMPLOYERS: "employers", n.ZERO_PAY_PEOPLE: "zero_pay_people"}


def pay_parts(salary: str, metrics: Sequence[str]) -> dict[str, str]:
    """Salaries that the wanted metrics add up, by SQL conditions.

    The mean needs those that count; it takes away the few that do not.
    """
    parts = {"paid": "true", "unpaid": f"{salary} <= 0"} if n.MEAN_PAY in metrics else {}
    return parts or ({"paid": "true"} if n.PAYROLL in metrics else {})


def odd_salaries(salary: str, metrics: Sequence[str]) -> dict[str, str]:
    """Conditions for salaries that are no finite number; :func:`finish` puts them back."""
    if n.PAYROLL not in metrics and n.MEAN_PAY not in metrics:
        return {}
    return {
        "nan": f"isnan({salary})",
        "up": f"{salary} = double('Infinity')",
        "down": f"{salary} = double('-Infinity')",
    }


def monthly_values(
    expanded: DataFrame, roles: Roles, metrics: Sequence[str] = METRICS
) -> DataFrame:
    """Values of rows that carry their month, named as by the sweep."""
    person, employer, salary = (
        quoted(c) for c in (roles.person, roles.employer, roles.salary)
    )
    heads = {
        "people": person,
        "employers": employer,
        "zero_pay_people": f"CASE WHEN {salary} = 0 THEN {person} END",
    }
    parts = pay_parts(salary, metrics)
    counts = expanded.groupBy(n.MONTH).agg(
        *[F.expr(f"count(DISTINCT {heads[HEADS[m]]}) AS {HEADS[m]}") for m in metrics if m in HEADS],
        *[
            F.expr(f"count_if({sql} AND {is_finite(salary)}) AS {part}_rows")
            for part, sql in parts.items()
        ],
        *[
            F.expr(f"coalesce(max(int({sql})), 0) AS {flag}")
            for flag, sql in odd_salaries(salary, metrics).items()
        ],
        F.expr("count(1) AS _rows"),
    ).drop("_rows")
    if not parts:
        return counts
    sums = (
        expanded.groupBy(n.MONTH, F.expr(f"{band(salary)} AS band"))
        .agg(
            *[
                F.expr(f"sum({units(salary)}) FILTER (WHERE {sql}) AS {part}_total")
                for part, sql in parts.items()
            ]
        )
        .where("band IS NOT NULL")
        .groupBy(n.MONTH)
        .agg(F.collect_list(F.struct("band", *[f"{p}_total" for p in parts])).alias("bands"))
    )
    # Both sides have one row per month.
    return counts.join(F.broadcast(sums), n.MONTH, "left")


def finish(values: DataFrame, month: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Report columns from the values of each month; ``month`` is SQL of the month text."""
    paid = total("bands", "x.paid_total")
    positive = total("bands", "coalesce(x.paid_total, 0) - coalesce(x.unpaid_total, 0)")
    shown = {
        n.PEOPLE: "people",
        n.EMPLOYERS: "employers",
        n.PAYROLL: f"""CASE WHEN nan > 0 OR (up > 0 AND down > 0) THEN double('NaN')
            WHEN up > 0 THEN double('Infinity')
            WHEN down > 0 THEN double('-Infinity')
            WHEN paid_rows > 0 THEN coalesce({paid}, 0D) END""",
        n.MEAN_PAY: f"""CASE WHEN nan > 0 THEN double('NaN')
            WHEN up > 0 THEN double('Infinity')
            ELSE {positive} / nullif(paid_rows - unpaid_rows, 0) END""",
        n.ZERO_PAY_PEOPLE: "zero_pay_people",
    }
    return values.selectExpr(
        f"{month} AS {n.MONTH}", *[f"{shown[m]} AS {m}" for m in METRICS if m in metrics]
    )


def fill_zeros(report: DataFrame) -> DataFrame:
    """Replace NULL and NaN metrics by zero."""
    zeros = {c: 0 if c in HEADS else 0.0 for c in METRICS}
    return report.fillna({c: zero for c, zero in zeros.items() if c in report.columns})


def fill_gaps(dim: DataFrame, monthly: DataFrame) -> DataFrame:
    """Every month of the axis, with zeros where nothing happened, in order.

    The monthly table is broadcast: it has one row per month of four-digit years at most.
    """
    return fill_zeros(dim.join(F.broadcast(monthly), n.MONTH, "left")).orderBy(n.MONTH)


def report_by_range_join(
    dim: DataFrame, detail: DataFrame, roles: Roles = Roles()
) -> DataFrame:
    rows = range_join(detail, dim, roles.start, roles.end)
    return fill_gaps(dim, finish(monthly_values(rows, roles), n.MONTH))


def report_by_expansion(
    dim: DataFrame, detail: DataFrame, roles: Roles = Roles()
) -> DataFrame:
    rows = expand(detail, roles.start, roles.end)
    return fill_gaps(dim, finish(monthly_values(rows, roles), n.MONTH))


def report_by_sweep(
    dim: DataFrame | None,
    detail: DataFrame,
    roles: Roles = Roles(),
    metrics: Sequence[str] = METRICS,
    checked: bool = False,
) -> DataFrame:
    """One pass over the periods; without ``dim`` the axis spans exactly these periods.

    Only the lanes that ``metrics`` need are built.
    """
    salary = quoted(roles.salary)
    changes = sweep(
        detail,
        roles,
        [HEADS[m] for m in METRICS if m in metrics and m in HEADS],
        pay_parts(salary, metrics),
        odd_salaries(salary, metrics),
        checked,
    )
    report = finish(accumulate(changes), MONTH_TEXT.format("_month"), metrics)
    return fill_zeros(report).orderBy(n.MONTH) if dim is None else fill_gaps(dim, report)


def monthly_report(
    detail: DataFrame,
    dim: DataFrame | None = None,
    roles: Roles = Roles(),
    metrics: Sequence[str] = METRICS,
    checked: bool = False,
) -> DataFrame:
    """Monthly report of periods that carry their person, by the sweep."""
    return report_by_sweep(dim, detail, roles, metrics, checked)


def report_for_months(
    detail: DataFrame,
    first: str,
    last: str,
    roles: Roles = Roles(),
    metrics: Sequence[str] = METRICS,
) -> DataFrame:
    """The report's months from ``first`` to ``last``, read from the periods that reach into them.

    Periods are cut off at both ends, so what began before comes in as open at the first month.  The two
    comparisons reach the scan: of files clustered by their end month (see ``clustered``) those that end
    before the range are skipped by their statistics.
    """
    for month in (first, last):
        if re.fullmatch(MONTH_PATTERN.removesuffix(r"\z"), month) is None:
            raise ValueError(f"{month!r} is no month")
    start, end = F.col(quoted(roles.start)), F.col(quoted(roles.end))
    near = detail.where((start <= last) & (end >= first)).where(is_valid(roles.start, roles.end))
    cut = near.withColumns({roles.start: F.greatest(start, F.lit(first)), roles.end: F.least(end, F.lit(last))})
    low, high = (12 * int(m[:4]) + int(m[4:]) - 1 for m in (first, last))
    dim = detail.sparkSession.range(low, high + 1).select(
        F.expr(MONTH_TEXT.format("int(id)")).alias(n.MONTH)
    )
    return monthly_report(cut, dim, roles, metrics, checked=True)


def clustered(detail: DataFrame, end: str = n.END, start: str = n.START) -> DataFrame:
    """Periods in ranges of their end month, to be written so that scans of few months skip files."""
    months = [F.col(quoted(c)) for c in (end, start)]
    return detail.repartitionByRange(*months).sortWithinPartitions(*months)


def report_summary(report: DataFrame) -> DataFrame:
    """Peak participants, payroll over all months, zero-pay head-months.

    The payrolls are added in the order of the months, so the sum is the same at every run; there
    is one per month of four-digit years at most.
    """
    payrolls = F.sort_array(F.collect_list(F.struct(n.MONTH, n.PAYROLL)))
    return report.agg(
        F.max(n.PEOPLE).alias(n.PEAK_PEOPLE),
        F.when(
            F.count(n.PAYROLL) > 0,
            F.aggregate(payrolls, F.lit(0.0), lambda s, x: s + F.coalesce(x[n.PAYROLL], F.lit(0.0))),
        ).alias(n.PAYROLL_OF_ALL_MONTHS),
        F.sum(n.ZERO_PAY_PEOPLE).alias(n.ZERO_PAY_HEAD_MONTHS),
    )


def present(report: DataFrame) -> DataFrame:
    """Report with reader's headings: ``YYYY-MM`` labels and whole numbers with separators."""
    shown = {c: whole_number(c) for c in n.REPORT_HEADINGS}
    shown[n.MONTH] = month_label(n.MONTH)
    return report.orderBy(n.MONTH).select(
        *[shown[c].alias(heading) for c, heading in n.REPORT_HEADINGS.items()]
    )
