"""Closed month intervals: bounds, gap-free month axis, expansion and sweep.

``expand`` and ``range_join`` produce one row per interval and month.  ``sweep`` never does: its
work grows with the number of intervals, not with their length.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.functions.amounts import band, is_finite, quoted, units
from spanlake.functions.months import month_index, month_text
from spanlake.operators.split import in_order, well_formed


@dataclass(frozen=True)
class Roles:
    """Columns that play the parts of a period row."""

    person: str = n.PERSON
    employer: str = n.EMPLOYER
    salary: str = n.SALARY
    start: str = n.START
    end: str = n.END


def month_bounds(detail: DataFrame, start: str = n.START, end: str = n.END) -> DataFrame:
    """One row: first start and last end over rows whose months are both well-formed."""
    return detail.where(well_formed(start, end)).agg(
        F.min(start).alias("first_month"), F.max(end).alias("last_month")
    )


def month_dim(detail: DataFrame, start: str = n.START, end: str = n.END) -> DataFrame:
    """Every month between the bounds, also months that no period touches.

    Empty when there is no well-formed period.  The bounds stay in the plan; nothing is collected.
    """
    bounds = month_bounds(detail, start, end).select(
        month_index("first_month").alias("lo"), month_index("last_month").alias("hi")
    )
    return (
        bounds.where("lo <= hi")
        .select(F.explode(F.sequence("lo", "hi")).alias("_month"))
        .select(month_text("_month").alias(n.MONTH))
    )


def expand(detail: DataFrame, start: str = n.START, end: str = n.END) -> DataFrame:
    """One row per period and month, without a join; reversed periods give none."""
    months = F.sequence(month_index(start), month_index(end))
    return (
        detail.where(well_formed(start, end) & in_order(start, end))
        .withColumn("_month", F.explode(months))
        .withColumn(n.MONTH, month_text("_month"))
        .drop("_month")
    )


def range_join(
    detail: DataFrame, dim: DataFrame, start: str = n.START, end: str = n.END
) -> DataFrame:
    """One row per period and month of the axis that lies in it.

    The months of a period are finitely many, so the range condition becomes an equality with
    each of them: a hash join with the axis instead of comparing every period with every month.
    The axis is broadcast: it has at most one row per four-digit year and month.
    """
    return expand(detail, start, end).join(F.broadcast(dim), n.MONTH)


def sweep(
    rows: DataFrame,
    roles: Roles,
    heads: Sequence[str] = ("people", "employers", "zero_pay_people"),
    parts: dict[str, str] | None = None,
    flags: dict[str, str] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Changes per month of distinct counts, amounts and flags.

    Returns a row per ``_month`` (index) and ``_band`` of amounts (see ``functions.amounts``; NULL for
    all that is no amount): the wanted ``heads``, for each part ``<part>_total`` and
    ``<part>_rows``, and each flag.  The running sum over the months is the value of a month.
    ``parts`` and ``flags`` map names to SQL conditions; a part sums the salaries of its rows, the
    value of a flag is 1 in months with such a row.  ``checked`` months are well-formed.

    A row is sent down one lane for each head, part and flag that it bears on, or if it has no part
    down one that only marks its months.  Every lane is aggregated before it is shuffled, to one row per entity and
    start month or, for amounts, per band, start and end month.  So a person, employer or flag
    with any number of periods reaches the window with no more rows than the axis has months.
    Lanes of heads and parts that are not wanted are not built.
    """
    parts, flags = parts or {}, flags or {}
    person, employer, salary = (
        quoted(c) for c in (roles.person, roles.employer, roles.salary)
    )
    known = {
        "people": ("_person", f"{person} IS NOT NULL"),
        "employers": ("_employer", f"{employer} IS NOT NULL"),
        "zero_pay_people": ("_person", f"{salary} = 0 AND {person} IS NOT NULL"),
    }
    entities = [c for c in ("_person", "_employer") if any(known[h][0] == c for h in heads)]
    source = {"_person": person, "_employer": employer}
    conditions = {
        **{h: known[h][1] for h in heads},
        **{p: f"({sql}) AND {is_finite(salary)}" for p, sql in parts.items()},
        **flags,
    }
    number = {name: i + 1 for i, name in enumerate(conditions)}

    def lanes_of(names: Iterable[str]) -> str:
        return ", ".join(str(number[x]) for x in names) or "-1"

    counted = f"_lane IN ({lanes_of([*heads, *flags])})"
    summed = f"_lane IN ({lanes_of(parts)})"
    chosen = [f"CASE WHEN _is_{i} THEN {i} ELSE -1 END" for i in number.values()]
    has_part = " OR ".join(f"_is_{number[x]}" for x in parts)
    marks = f"CASE WHEN {has_part} THEN -1 ELSE 0 END" if parts else "0"
    amount = ["_band", "_units"] if parts else []
    lanes = (
        rows.select(
            month_index(roles.start, checked).alias("_from"),
            month_index(roles.end, checked).alias("_to"),
            *[F.expr(f"{source[c]} AS {c}") for c in entities],
            *(
                [F.expr(f"{band(salary)} AS _band"), F.expr(f"{units(salary)} AS _units")]
                if parts
                else []
            ),
            *[F.expr(f"coalesce({sql}, false) AS _is_{number[x]}") for x, sql in conditions.items()],
        )
        .selectExpr(
            # Malformed and reversed months get no lane.  A filter for them would be pushed below
            # the projection and work out both months a second time.
            f"""explode(CASE WHEN _from > _to OR _from IS NULL OR _to IS NULL THEN NULL
                  ELSE array({", ".join([marks, *chosen])}) END) AS _lane""",
            *entities,
            "_from",
            "_to",
            *amount,
        )
        .where("_lane >= 0")
    )
    keys = {
        c: f"CASE WHEN _lane IN ({lanes_of(h for h in heads if known[h][0] == c)}) THEN {c} END"
        for c in entities
    }
    grouped = lanes.selectExpr(
        "_lane",
        *[f"{sql} AS {c}" for c, sql in keys.items()],
        "_from",
        f"CASE WHEN NOT ({counted}) THEN _to END AS _until",
        "_to",
        *[f"CASE WHEN {summed} THEN {c} END AS {c}" for c in amount],
    )
    entity_months = grouped.groupBy(
        "_lane", *entities, "_from", "_until", *(["_band"] if parts else [])
    ).agg(
        F.expr("max(_to) AS _to"),
        *(
            [F.expr("sum(_units) AS _units"), F.expr("count(1) AS _rows")]
            if parts
            else []
        ),
    )
    amounts = ["_band", "_units", "_rows"] if parts else []
    if heads or flags:
        # The part of an interval that no earlier-starting interval of the same entity covers.
        entity_months = (
            entity_months.selectExpr(
                "*",
                f"""CASE WHEN {counted} THEN max(_to) OVER (
                      PARTITION BY {", ".join(["_lane", *entities])},
                        CASE WHEN NOT ({counted}) THEN _from END
                      ORDER BY _from ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                    END AS _covered""",
            )
            .where("_covered IS NULL OR _covered < _to")
            .selectExpr(
                "_lane", "greatest(_from, _covered + 1) AS _from", "_to", *amounts
            )
        )
    # Once as opening and once as closing change.
    edges = entity_months.selectExpr(
        "_lane", "_from", "_to + 1 AS _until", *amounts, "explode(array(1, -1)) AS _sign"
    )
    signed = "CASE WHEN _sign = 1 THEN _units ELSE -_units END"
    month = F.expr("CASE WHEN _sign = 1 THEN _from ELSE _until END AS _month")
    return edges.groupBy(
        month, F.expr(f"{'_band' if parts else 'int(NULL)'} AS _band")
    ).agg(
        *[
            F.expr(f"coalesce(sum(_sign) FILTER (WHERE _lane = {number[x]}), 0) AS {x}")
            for x in [*heads, *flags]
        ],
        *[
            F.expr(f"coalesce(sum({sql}) FILTER (WHERE _lane = {number[x]}), 0) AS {x}_{what}")
            for x in parts
            for what, sql in (("total", signed), ("rows", "_sign * _rows"))
        ],
    )


def accumulate(changes: DataFrame) -> DataFrame:
    """Values per month (``_month``) from the changes of :func:`sweep`.

    The axis runs from the first start to the last end.  Values are constant between two changes, so
    each change is repeated up to the next one of its band.  The amounts of a month become the
    array ``bands``.  The windows run over changed months and bands only: at most
    ``months.MAX_MONTHS`` times the bands in use.
    """
    values = [c for c in changes.columns if c not in ("_month", "_band")]
    totals = [c for c in values if c.endswith("_total")]
    running = [
        f"sum({c}) OVER (PARTITION BY _band ORDER BY _month ROWS UNBOUNDED PRECEDING) AS {c}"
        for c in values
    ]
    empty = "CAST(array() AS array<struct<m:int,own:boolean>>)"
    own, gap = (
        f"CASE WHEN {until} > _month"
        f" THEN transform(sequence(_month, {until} - 1), m -> struct(m AS m, {is_own} AS own)) END"
        for until, is_own in (("_next", "true"), ("_gap", "false"))
    )
    months = changes.selectExpr(
        "_month",
        "_band",
        "lead(_month) OVER (PARTITION BY _band ORDER BY _month) AS _next",
        "lead(_month) OVER (ORDER BY _month) AS _gap",
        *running,
    ).selectExpr(
        # A month that no band reaches is on the axis all the same.
        f"explode(concat(coalesce({own}, {empty}), coalesce({gap}, {empty}))) AS _at",
        "_band",
        *values,
    )
    return months.groupBy(F.expr("_at.m AS _month")).agg(
        *[
            F.expr(f"coalesce(sum({c}) FILTER (WHERE _at.own), 0) AS {c}")
            for c in values
            if c not in totals
        ],
        F.expr(
            f"collect_list(struct({', '.join(['_band AS band', *totals])}))"
            " FILTER (WHERE _at.own AND _band IS NOT NULL) AS bands"
        ),
    )
