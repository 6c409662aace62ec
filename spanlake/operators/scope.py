"""Linking contribution periods to snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake import names as n
from spanlake.functions.amounts import quoted
from spanlake.operators.skew import join_keyed


def slim(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Select and rename: ``{old name: new name}``."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def scope_to_latest(
    detail: DataFrame,
    latest: DataFrame,
    links: dict[str, str] | None = None,
    **skew,
) -> DataFrame:
    """Periods whose linking columns all equal those of one kept snapshot.

    ``links`` maps detail columns to snapshot columns (period's snapshot id and worker id by
    default).  As a semi-join it never multiplies periods, also when snapshot ids repeat.
    """
    links = links or {n.MASTER_ID: n.ID, n.WORKER: n.WORKER}
    known = slim(latest, {snapshot: period for period, snapshot in links.items()})
    return join_keyed(detail, known, list(links), "left_semi", **skew)


def judge_links(
    detail: DataFrame,
    latest: DataFrame,
    master_id: str = n.MASTER_ID,
    worker: str = n.WORKER,
    snapshot_id: str = n.ID,
    snapshot_worker: str = n.WORKER,
) -> DataFrame:
    """Periods of kept snapshots, with ``_same_worker``: their worker is one of that snapshot's.

    The snapshots are grouped by id, so repeated ids do not repeat periods.  Snapshots without id are
    left out first: no period can be theirs, and they would all be one group.
    """
    named = latest.where(F.col(quoted(snapshot_id)).isNotNull())
    known = named.groupBy(F.col(quoted(snapshot_id)).alias("_known")).agg(
        F.collect_set(snapshot_worker).alias("_workers")
    )
    same = F.coalesce(F.array_contains("_workers", F.col(worker)), F.lit(False))
    joined = detail.join(known, F.col(master_id) == F.col("_known"))
    return joined.select(*[F.col(quoted(c)) for c in detail.columns], same.alias("_same_worker"))


def with_snapshot_columns(
    detail: DataFrame,
    latest: DataFrame,
    columns: Sequence[str] = (n.PERSON,),
    master_id: str = n.MASTER_ID,
    snapshot_id: str = n.ID,
    **skew,
) -> DataFrame:
    """Attach snapshot columns (the person) to each period; periods without snapshot drop out."""
    side = slim(latest, {snapshot_id: master_id, **{c: c for c in columns}})
    return join_keyed(detail, side, [master_id], "inner", **skew)


def orphans(
    detail: DataFrame,
    latest: DataFrame,
    master_id: str = n.MASTER_ID,
    snapshot_id: str = n.ID,
    **skew,
) -> DataFrame:
    """Periods whose snapshot id is NULL or unknown."""
    return join_keyed(
        detail, slim(latest, {snapshot_id: master_id}), [master_id], "left_anti", **skew
    )
