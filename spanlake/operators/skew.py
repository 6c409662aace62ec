"""Equi-joins on keys of which a few may hold a large part of all rows.

The plain join is enough in general: at run time Spark splits the left side's part of a partition
that is far larger than the others (``spark.sql.adaptive.skewJoin``), for inner, semi and anti
joins.  :func:`join_salted` is the same join for sessions without it: it counts every key and
spreads the frequent ones by the rows' hashes.  Neither looks at the size of its input to choose a plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_SALT = 5_000_000
"""Rows of one key that a single task may receive."""

MOST_HOT_KEYS = 1_000_000
"""Bound of the broadcast table of hot keys; see :func:`hot_keys`."""


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_salt: int = ROWS_PER_SALT
) -> DataFrame:
    """Hashes of the keys with more rows than a task may receive, and their number of salts.

    All keys are counted, combined before the shuffle.  As N rows have no more than N / r keys with
    more than r rows each, raising r to N / ``MOST_HOT_KEYS`` bounds this table; that takes effect from
    5 * 10^12 rows on.
    """
    counted = df.groupBy(F.xxhash64(*keys).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    total = df.agg(F.count(F.lit(1))).scalar()
    limit = F.greatest(F.lit(rows_per_salt), F.ceil(total / MOST_HOT_KEYS))
    return counted.where(F.col("_rows") > limit).select(
        "_key", F.ceil(F.col("_rows") / limit).cast("int").alias("_salts")
    )


def _hashable(df: DataFrame) -> list[str]:
    """Columns whose values can be hashed."""

    def plain(kind: T.DataType) -> bool:
        if isinstance(kind, T.StructType):
            return all(plain(f.dataType) for f in kind.fields)
        if isinstance(kind, T.ArrayType):
            return plain(kind.elementType)
        return not isinstance(kind, (T.MapType, T.VariantType))

    return [f.name for f in df.schema.fields if plain(f.dataType)]


def join_salted(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Equi-join in which a hot key's left rows are spread over its salts.

    The right rows of a hot key are repeated once per salt.  A left row takes its salt from its own
    values, so it does not matter in which partition it lies, and a re-run task repeats it; only
    rows that are equal in all columns stay together.  ``how`` is ``inner``, ``left_semi`` or
    ``left_anti``; NULL keys match nothing and are spread as well.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} cannot be salted on the right side")
    for c in on:
        if left.schema[c].dataType != right.schema[c].dataType:
            raise TypeError(f"join column {c!r} has different types on the two sides")
    hot = F.broadcast(hot_keys(left, on, rows_per_salt))
    row = F.xxhash64(*_hashable(left))
    has_null = F.greatest(*[F.col(c).isNull() for c in on], F.lit(False))
    spread = (
        left.withColumn("_key", F.xxhash64(*on))
        .join(hot, "_key", "left")
        .withColumn(
            "_salt",
            F.when(has_null, F.pmod(row, F.lit(1 << 20)))
            .when(F.col("_salts").isNotNull(), F.pmod(row, F.col("_salts")))
            .otherwise(0)
            .cast("int"),
        )
        .drop("_key", "_salts")
    )
    repeated = (
        right.withColumn("_key", F.xxhash64(*on))
        .join(hot, "_key", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_key", "_salts")
    )
    return _in_order(spread.join(repeated, [*on, "_salt"], how), left, right, how)


def _in_order(joined: DataFrame, left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Columns of the left side as they were, then the new ones of the right side."""
    new = [c for c in right.columns if c not in left.columns] if how == "inner" else []
    return joined.select(*left.columns, *new)


def join_keyed(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    rows_per_salt: int | None = None,
) -> DataFrame:
    """The plain join, or with ``rows_per_salt`` the salted one."""
    if rows_per_salt is not None:
        return join_salted(left, right, on, how, rows_per_salt)
    return _in_order(left.join(right, list(on), how), left, right, how)
