"""All rules of a set of tables in one pass: each table is scanned once, all keys share one exchange.

A row becomes a tagged key for each rule that it bears on.  The tagged keys of all tables are put below each
other and counted per tag and key, before and after one shuffle; a rule reads its violations off
these counts.  A frequent key is one row per task by then, and a row rule sends one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.functions.amounts import quoted
from spanlake.operators.split import well_formed


class RowRule(NamedTuple):
    """Rows of ``table`` for which the condition holds."""

    rule: str
    table: str
    violated: Column


class UniqueRule(NamedTuple):
    """Keys of ``table`` with more than one row; NULL counts as a key."""

    rule: str
    table: str
    keys: tuple[str, ...]


class LinkRule(NamedTuple):
    """Rows of ``table`` whose linking columns are NULL or match no row of ``known``."""

    rule: str
    table: str
    known: str
    links: tuple[tuple[str, str], ...]
    """Column of the table and the known one that it refers to."""


Rule = RowRule | UniqueRule | LinkRule


def _key(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(quoted(c)).cast("string") for c in columns])


def _entry(tag: int, key: Column, here: int, there: int, when: Column | None = None) -> Column:
    made = F.struct(
        F.lit(tag).alias("tag"), key.alias("key"), F.lit(here).alias("here"), F.lit(there).alias("there")
    )
    return made if when is None else F.when(when, made)


def fused(tables: dict[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """``rule`` and ``violations`` of every rule, also of those that nothing violates."""
    entries: dict[str, list[Column]] = {name: [] for name in tables}
    nothing = F.lit(None).cast("array<string>")
    for tag, rule in enumerate(rules):
        if isinstance(rule, RowRule):
            entries[rule.table].append(_entry(tag, nothing, 1, 0, F.coalesce(rule.violated, F.lit(False))))
        elif isinstance(rule, UniqueRule):
            entries[rule.table].append(_entry(tag, _key(rule.keys), 1, 0))
        else:
            mine, theirs = zip(*rule.links)
            entries[rule.table].append(_entry(tag, _key(mine), 1, 0))
            # A known row with a NULL matches nothing.
            whole = reduce(lambda a, b: a & b, [F.col(quoted(c)).isNotNull() for c in theirs])
            entries[rule.known].append(_entry(tag, _key(theirs), 0, 1, whole))
    spark = next(iter(tables.values())).sparkSession
    seeds = spark.range(1).select(F.explode(F.array(*[_entry(t, nothing, 0, 0) for t in range(len(rules))])).alias("e"))
    tagged = [seeds.select("e.*")]
    for name, made in entries.items():
        if made:
            exploded = tables[name].select(F.explode(F.array(*made)).alias("e")).where("e IS NOT NULL")
            tagged.append(exploded.select("e.*"))
    counted = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("tag", "key")
        .agg(F.sum("here").alias("here"), F.sum("there").alias("there"))
    )
    here, there = F.col("here"), F.col("there")
    shares = {
        RowRule: here,
        UniqueRule: (here > 1).cast("bigint"),
        LinkRule: F.when(there == 0, here).otherwise(0),
    }
    tag = F.col("tag")
    share = reduce(
        lambda chain, r: chain.when(tag == r[0], shares[type(r[1])]), enumerate(rules), F
    )
    names = F.array(*[F.lit(r.rule) for r in rules])
    found = counted.groupBy("tag").agg(F.sum(share).alias("violations"))
    return found.select(F.get(names, tag).alias("rule"), F.col("violations").cast("bigint"))


def lake_rules(
    snapshots: str = "snapshots",
    periods: str = "periods",
    report: str | None = "report",
    snapshot_id: str = n.ID,
    master_id: str = n.MASTER_ID,
    person: str = n.PERSON,
    start: str = n.START,
    end: str = n.END,
    scoped: str | None = None,
    malformed: bool = True,
) -> list[Rule]:
    """What the written tables of a lake have to keep; ``scoped`` names the periods whose months are
    checked, if these are another table."""
    dated = scoped or periods
    rules: list[Rule] = [
        LinkRule("orphan periods", periods, snapshots, ((master_id, snapshot_id),)),
        UniqueRule("persons with several snapshots", snapshots, (person,)),
        RowRule("reversed periods", dated, F.col(quoted(start)) > F.col(quoted(end))),
    ]
    if malformed:
        bad = ~F.coalesce(well_formed(start, end), F.lit(False))
        rules.append(RowRule("malformed periods", dated, bad))
    if report is not None:
        rules.append(UniqueRule("duplicate months", report, (n.MONTH,)))
    return rules
