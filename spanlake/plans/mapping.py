"""Period data read out of the orders and line items of the test tables.

An order is a snapshot of its customer, a line item a period of that order: employed by the
supplier, paid the extended price, from the month of the order to the month of shipping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.functions.months import month_of
from spanlake.operators.intervals import Roles
from spanlake.operators.latest import latest_per_key
from spanlake.operators.scope import with_snapshot_columns
from spanlake.sources.files import read_table

ROLES = Roles("person", "employer", "salary", "from_month", "to_month")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("person"),
        F.col("o_orderdate").alias("created"),
        month_of("o_orderdate").alias("from_month"),
    )


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(snapshots(spark, sf_dir), ["person"], ["created", "id"])


def salary() -> Column:
    return F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_extendedprice"))


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as periods; their start month comes with the snapshot."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("master_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("employer"),
        salary().alias("salary"),
        month_of("l_shipdate").alias("to_month"),
    )


def scoped(spark: SparkSession, sf_dir: str, pay: Column | None = None) -> DataFrame:
    """Periods of the latest snapshots, with person and start month; not yet split."""
    rows = periods(spark, sf_dir)
    rows = rows if pay is None else rows.withColumn("salary", pay)
    return with_snapshot_columns(
        rows, latest(spark, sf_dir), ["person", "from_month"], "master_id", "id"
    )


def every_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as valid periods of three to 21 months that end with the shipping."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("master_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("employer"),
        salary().alias("salary"),
        month_of(F.add_months("l_shipdate", F.col("l_linenumber") * -3)).alias("from_month"),
        month_of("l_shipdate").alias("to_month"),
    )
    people = snapshots(spark, sf_dir).drop("from_month")
    return with_snapshot_columns(rows, people, ["person"], "master_id", "id")


def messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items with months as raw input may hold them, and pay as text.

    The quantity decides what is wrong with a month: missing, padded with blanks or a tab, ended
    by a line break, month 13, blanks only, a letter in front, or year 0000.
    """
    start = month_of(F.add_months("l_shipdate", 6 - F.col("l_linenumber") * 3))
    end = month_of("l_shipdate")
    quantity = F.col("l_quantity")
    before = F.when(quantity == 2, "  ").when(quantity == 3, "\t").when(quantity == 6, "   ")
    after = F.when(quantity == 2, " ").when(quantity == 4, "\n").when(quantity == 5, "13")
    length = F.when(quantity == 5, 4).when(quantity == 6, 0).otherwise(6)
    front = F.when(quantity == 8, "x").when(quantity == 9, "0000")
    begin = F.when(quantity == 9, 5).otherwise(1)
    nothing = F.lit("")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("master_id"),
        F.col("l_linenumber").alias("line"),
        F.when(
            quantity != 1,
            F.concat(
                F.coalesce(before, nothing),
                F.substring(start, F.lit(1), length),
                F.coalesce(after, nothing),
            ),
        ).alias("from_month"),
        F.when(
            ~quantity.isin(1, 7),
            F.concat(F.coalesce(front, nothing), F.substring(end, begin, F.lit(6))),
        ).alias("to_month"),
        F.when(F.col("l_discount") == 0.01, "n/a")
        .otherwise(F.col("l_extendedprice").cast("string"))
        .alias("salary"),
    )
