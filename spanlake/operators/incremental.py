"""Loads that arrive one after the other: latest snapshot per key, and the monthly report.

The snapshot table keeps the current winner of each key and, as deleted rows, the winners that it
replaced.  The report's state is additive: a load adds the changes of its new periods and takes away
those of its removed ones, so it never reads the periods of earlier loads again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.functions.amounts import band, is_finite, quoted, units
from spanlake.functions.months import MONTH_TEXT, month_index
from spanlake.operators.intervals import Roles, accumulate
from spanlake.operators.latest import latest_per_key, with_soft_delete
from spanlake.operators.report import HEADS, METRICS, fill_zeros, finish, odd_salaries, pay_parts

# Snapshots


def _same_key(keys: Sequence[str]) -> Column:
    """Keys of both sides are equal; NULL is a key."""
    pairs = [F.col(f"_a.{quoted(k)}").eqNullSafe(F.col(f"_b.{quoted(k)}")) for k in keys]
    return reduce(lambda x, y: x & y, pairs)


def latest_changes(
    table: DataFrame,
    load: DataFrame,
    keys: Sequence[str] = (n.PERSON,),
    order: Sequence[str] = (n.CREATED, n.ID),
) -> DataFrame:
    """What a load does to each key: ``keys``, ``change`` and the order columns of both winners.

    ``change`` is ``new`` (first row of the key), ``replaced``, ``late`` (the load's newest row is not newer
    than the winner) or ``untouched``.  A full outer join of the keys and order columns only.
    """
    old = _winners(table).select(*keys, F.struct(*order).alias("old"))
    new = latest_per_key(load, keys, order).select(*keys, F.struct(*order).alias("new"))
    both = old.alias("_a").join(new.alias("_b"), _same_key(keys), "full")
    change = (
        F.when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "untouched")
        .when(F.col("new") > F.col("old"), "replaced")
        .otherwise("late")
    )
    return both.select(
        *[
            F.when(F.col("old").isNull(), F.col(f"_b.{quoted(k)}"))
            .otherwise(F.col(f"_a.{quoted(k)}"))
            .alias(k)
            for k in keys
        ],
        change.alias("change"),
        "old",
        "new",
    )


def _winners(table: DataFrame) -> DataFrame:
    return table.where(F.col(n.IS_DELETED) == 0)


def latest_merge(
    table: DataFrame | None,
    load: DataFrame,
    at: Column | None = None,
    keys: Sequence[str] = (n.PERSON,),
    order: Sequence[str] = (n.CREATED, n.ID),
) -> DataFrame:
    """The snapshot table after one more load.

    ``table`` is the result of the loads before, None for the first one.  Rows whose flag is 0 are then
    the latest rows of all loads, whatever came in which; a winner that the load replaces gets
    flag 1 and the time ``at`` (now, if not given); rows deleted earlier stay as they are.  Late rows, older
    than the winner or equal to it in the order columns, change nothing, so a load that is repeated is
    without effect.

    The wide rows of the table are not shuffled for a load that can be broadcast: they meet the load's
    keys and order columns only, and of the table's own keys those that the load names.
    """
    newest = latest_per_key(load, keys, order)
    if table is None:
        return with_soft_delete(newest)
    coming = newest.select(*keys, F.struct(*order).alias("_new"))
    time = F.current_timestamp() if at is None else at
    beaten = F.coalesce(
        (F.col(n.IS_DELETED) == 0) & (F.col("_new") > F.struct(*[F.col(f"_a.{quoted(c)}") for c in order])),
        F.lit(False),
    )
    stay = table.alias("_a").join(coming.alias("_b"), _same_key(keys), "left")
    stay = stay.select(
        *[
            F.when(beaten, 1).otherwise(F.col(n.IS_DELETED)).alias(c)
            if c == n.IS_DELETED
            else F.when(beaten, time).otherwise(F.col(n.DELETED_AT)).alias(c)
            if c == n.DELETED_AT
            else F.col(f"_a.{quoted(c)}").alias(c)
            for c in table.columns
        ]
    )
    held = _winners(table).select(*keys, F.struct(*order).alias("_old"))
    held = held.alias("_a").join(coming.alias("_b"), _same_key(keys), "left_semi")
    win = newest.alias("_a").join(held.alias("_b"), _same_key(keys), "left")
    newer = F.struct(*[F.col(f"_a.{quoted(c)}") for c in order]) > F.col("_old")
    win = win.where(F.col("_old").isNull() | newer).select(
        *[F.col(f"_a.{quoted(c)}").alias(c) for c in load.columns]
    )
    return stay.unionByName(with_soft_delete(win))


# Report


@dataclass(frozen=True)
class ReportState:
    """What earlier loads have left.

    ``edges``: for each lane and entity how many of its periods more (or fewer) are open from a month on.
    Rows of one lane, entity and month may be several, from different loads; they add up.
    ``changes``: for each month and band of amounts the changes of all values, as in the sweep.
    """

    edges: DataFrame
    changes: DataFrame


ENTITY = ["_lane", "_person", "_employer"]


def _edges(rows: DataFrame, roles: Roles, heads: Sequence[str], sign: int) -> DataFrame:
    """Edges of the periods, a row for each lane, entity and month."""
    person, employer, salary = (quoted(c) for c in (roles.person, roles.employer, roles.salary))
    lanes = {
        "people": (f"{person} IS NOT NULL", person, "NULL"),
        "employers": (f"{employer} IS NOT NULL", "NULL", employer),
        "zero_pay_people": (f"{salary} = 0 AND {person} IS NOT NULL", person, "NULL"),
    }
    kinds = dict(rows.dtypes)
    made = ", ".join(
        f"CASE WHEN {condition} THEN struct('{h}' AS lane,"
        f" CAST({p} AS {kinds[roles.person]}) AS person, CAST({e} AS {kinds[roles.employer]}) AS employer) END"
        for h, (condition, p, e) in lanes.items()
        if h in heads
    )
    lane = rows.select("_from", "_to", F.expr(f"explode(array({made})) AS l")).where("l IS NOT NULL")
    # Both ends of a period; they are added up before the exchange.
    ends = lane.selectExpr(
        "l.lane AS _lane", "l.person AS _person", "l.employer AS _employer",
        f"explode(array(struct(_from AS m, bigint({sign}) AS d), struct(_to + 1 AS m, bigint({-sign}) AS d))) AS e",
    )
    return ends.groupBy(*ENTITY, F.col("e.m").alias("_month")).agg(F.sum("e.d").alias("delta"))


def _presence(edges: DataFrame, before: DataFrame | None, heads: Sequence[str]) -> DataFrame:
    """Per month by how many entities each head changes: they are present while a period is open.

    What the same entities changed ``before`` is taken away.  Sums and windows share one exchange by
    entity; the edges are added up by month already.
    """
    both = edges.withColumn("was", F.lit(0).cast("bigint"))
    if before is not None:
        both = both.unionByName(before.withColumn("was", F.col("delta")))
    summed = (
        both.repartition(*ENTITY)
        .groupBy(*ENTITY, "_month")
        .agg(F.sum("delta").alias("delta"), F.sum("was").alias("was"))
    )
    open_at = """sum({0}) OVER (PARTITION BY _lane, _person, _employer ORDER BY _month
             ROWS UNBOUNDED PRECEDING) AS {0}_open"""
    turned = summed.selectExpr(
        "_lane", "_month", "delta", "was", *[open_at.format(c) for c in ("delta", "was")]
    ).selectExpr(
        "_lane",
        "_month",
        "int(delta_open > 0) - int(delta_open - delta > 0)"
        " - int(was_open > 0) + int(was_open - was > 0) AS turn",
    )
    return turned.where("turn <> 0").groupBy("_month").agg(
        *[F.expr(f"coalesce(sum(turn) FILTER (WHERE _lane = '{h}'), 0) AS {h}") for h in heads]
    )


def _amounts(
    rows: DataFrame, roles: Roles, parts: dict[str, str], flags: dict[str, str], sign: int
) -> DataFrame:
    """Per month and band the changes of amounts, of flagged rows and of the number of periods."""
    salary = quoted(roles.salary)
    sums = [
        F.expr(f"{made} AS {name}")
        for part, sql in parts.items()
        for name, made in (
            (f"{part}_total", f"coalesce(sum(_units) FILTER (WHERE _{part}), 0)"),
            (f"{part}_rows", f"count_if(_{part})"),
        )
    ]
    spans = (
        rows.select(
            "_from",
            "_to",
            F.expr(f"{band(salary)} AS _band"),
            F.expr(f"{units(salary)} AS _units"),
            *[F.expr(f"({sql}) AND {is_finite(salary)} AS _{p}") for p, sql in parts.items()],
            *[F.expr(f"{sql} AS _{f}") for f, sql in flags.items()],
        )
        .groupBy("_from", "_to", "_band")
        .agg(*sums, *[F.expr(f"count_if(_{f}) AS {f}") for f in flags], F.expr("count(1) AS _periods"))
    )
    values = [c for c in spans.columns if c not in ("_from", "_to", "_band")]
    ends = spans.selectExpr(
        "_band", *values,
        f"explode(array(struct(_from AS m, {sign} AS s), struct(_to + 1 AS m, {-sign} AS s))) AS e",
    )
    return _summed(
        ends.selectExpr("e.m AS _month", "_band", *[f"e.s * {c} AS {c}" for c in values])
    )


def _summed(changes: DataFrame) -> DataFrame:
    """Changes added up; months and bands in which nothing is left are dropped."""
    values = [c for c in changes.columns if c not in ("_month", "_band")]

    def kind(c: str) -> str:
        return "decimal(38,0)" if c.endswith("_total") else "bigint"

    made = changes.groupBy("_month", "_band").agg(
        *[F.expr(f"CAST(coalesce(sum({c}), 0) AS {kind(c)}) AS {c}") for c in values]
    )
    return made.where(" OR ".join(f"{c} <> 0" for c in values))


def report_load(
    state: ReportState | None,
    added: DataFrame | None,
    removed: DataFrame | None = None,
    roles: Roles = Roles(),
    metrics: Sequence[str] = METRICS,
    stage: Callable[[DataFrame], DataFrame] = lambda edges: edges,
) -> tuple[DataFrame, DataFrame]:
    """Edges to append to the state, and its changes anew, after periods were added and removed.

    ``stage`` may store the edges, so that the changes are made from what was stored.

    ``removed`` are periods of earlier loads, with all the columns that ``roles`` name.  Only the edges of
    entities that the load names are read: what they counted for before is taken away from the
    changes, what they count for now is added.  Amounts are exact decimals, so they cancel entirely.
    Rows with malformed or reversed months are left out, as in the report.
    """
    salary = quoted(roles.salary)
    heads = [HEADS[m] for m in METRICS if m in metrics and m in HEADS]
    parts, flags = pay_parts(salary, metrics), odd_salaries(salary, metrics)
    sides = []
    for rows, sign in ((added, 1), (removed, -1)):
        if rows is not None:
            bounded = rows.withColumns(
                {"_from": month_index(roles.start), "_to": month_index(roles.end)}
            ).where("_from <= _to")
            sides.append((bounded, sign))
    if not sides:
        raise ValueError("a load needs periods that are added or removed")
    amounts = reduce(
        DataFrame.unionByName, [_amounts(rows, roles, parts, flags, sign) for rows, sign in sides]
    )
    found = [amounts]
    edges = stage(
        reduce(
            DataFrame.unionByName, [_edges(rows, roles, heads or ["people"], sign) for rows, sign in sides]
        )
    )
    if heads:
        before = None
        if state is not None:
            named = edges.select(*ENTITY).distinct()
            before = state.edges.alias("_a").join(named.alias("_b"), _same_key(ENTITY), "left_semi")
        found.append(_presence(edges, before, heads))
    if state is not None:
        found.append(state.changes)
    changes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    return edges, _summed(changes)


def report_of(changes: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """The monthly report that the changes of all loads add up to."""
    values = finish(accumulate(changes), MONTH_TEXT.format("_month"), metrics)
    return fill_zeros(values).orderBy(n.MONTH)
