"""Latest record per key and the soft-delete columns of the snapshot table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanlake import names as n


def newest_first(*columns: str) -> list[Column]:
    """Descending order over the columns, NULLs last."""
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] = (n.PERSON,),
    order: Sequence[str] = (n.CREATED, n.ID),
) -> DataFrame:
    """Keep the newest row of every key; NULL keys form one group.

    ``row_number() = 1`` is planned as a group limit before and after the shuffle, so a key that
    holds a large part of the table sends one row per input partition, not all its rows.
    """
    newest = Window.partitionBy(*keys).orderBy(*newest_first(*order))
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def latest_per_key_by_max(
    df: DataFrame,
    keys: Sequence[str] = (n.PERSON,),
    order: Sequence[str] = (n.CREATED, n.ID),
) -> DataFrame:
    """Same result as :func:`latest_per_key`, as one aggregation.

    The order columns lead the compared struct.  NULL is the smallest struct field, which is
    NULLs last in descending order.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = F.max_by(F.struct(*order, *rest), F.struct(*order))
    picked = df.groupBy(*keys).agg(newest.alias("_row"))
    return picked.select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
    )


def with_time(df: DataFrame, column: str = n.CREATED, parsed: str = "_time") -> DataFrame:
    """Add the time that a text column stands for, NULL where it stands for none.

    Needed as order of :func:`latest_per_key` only if the texts differ in width; with a fixed
    width text order is time order.
    """
    return df.withColumn(parsed, F.try_to_timestamp(column))


def with_soft_delete(df: DataFrame) -> DataFrame:
    """Add the columns of an active row: flag 0 and no deletion time."""
    return df.withColumns(
        {n.IS_DELETED: F.lit(0), n.DELETED_AT: F.lit(None).cast("timestamp")}
    )
