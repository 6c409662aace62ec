"""CSV files with quoted line breaks, each read by many tasks."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from spanlake.functions.amounts import quoted
from spanlake.session import scratch_path
from spanlake.sources.files import CSV_DIALECT, read_csv, write_table

PIECE = ["file", "block"]

FIELD = "\x01"
"""Stands for a quoted stretch while a line is checked; a line that holds it is not split."""


def quote_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their place: ``file``, ``block`` (where the piece of the file begins), ``row`` (ascending
    within the piece), ``line``, ``odd`` (1 if it has an odd number of quotes) and ``ahead``, the odd lines
    of the piece before it.

    A scan gives a piece's lines one after the other, so they are counted as they pass.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("line"),
        (quote_count(F.col("value")) % 2).alias("odd"),
    )
    return lines.mapInArrow(_counted, "file string, block long, row long, line string, odd int, ahead long")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece, total = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        begins = _piece_begins(batch)
        odd = np.concatenate([[0], np.cumsum(batch.column("odd").to_numpy())]).astype(np.int64)
        first = (batch.column("file")[0].as_py(), batch.column("block")[0].as_py())
        carried = total if first == piece else 0
        base = odd[begins]
        base[0] -= carried
        sizes = np.diff(np.append(begins, batch.num_rows))
        yield batch.append_column("ahead", pa.array(odd[:-1] - np.repeat(base, sizes)))
        piece = (batch.column("file")[-1].as_py(), batch.column("block")[-1].as_py())
        total = int(odd[-1] - base[-1])


def _piece_begins(batch: pa.RecordBatch) -> np.ndarray:
    """Where lines of another piece begin, the first line included."""
    new = np.ones(batch.num_rows, bool)
    new[1:] = np.diff(batch.column("block").to_numpy()) != 0
    files = batch.column("file")
    new[1:] |= pc.not_equal(files[1:], files[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def file_pieces(lines: DataFrame) -> DataFrame:
    """Each piece of a file with ``base``, the odd lines of the file before it, ``odds``, those of the whole
    file, and ``header``, the row of the file's first line that is not empty (in its piece, else NULL).

    One row a piece reaches the window, so it stays small for files of any size.
    """
    pieces = lines.groupBy(*PIECE).agg(
        F.sum("odd").alias("odd"), F.min(F.when(F.col("line") != "", F.col("row"))).alias("first")
    )
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    top = F.min(F.when(F.col("first").isNotNull(), F.col("block"))).over(file)
    return pieces.select(
        *PIECE,
        F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("base"),
        F.sum("odd").over(file).alias("odds"),
        F.when(F.col("block") == top, F.col("first")).alias("header"),
    )


def unsplittable(line: Column, inside: Column) -> Column:
    """Whether quotes are anywhere but around whole fields, so that counting them does not tell records.

    ``inside``: the line begins within quotes.  Lines with a carriage return count as well.
    """
    whole = F.concat(F.when(inside, '"').otherwise(""), line)
    closed = F.regexp_replace(whole, '"[^"]*"', FIELD)
    shape = F.regexp_replace(closed, '"[^"]*$', '"')
    astray = shape.rlike(f'[^,{FIELD}]["{FIELD}]|{FIELD}[^,{FIELD}"]')
    return astray | line.contains(FIELD) | line.contains("\r")


def judged_lines(lines: DataFrame, pieces: DataFrame) -> DataFrame:
    """Lines with ``before``, the odd lines of their file ahead of them, and ``astray``.

    There is a piece for each task of the scan, as many as the driver plans: fit to be broadcast.
    """
    placed = lines.join(F.broadcast(pieces), PIECE)
    counted = placed.withColumn("before", F.col("base") + F.col("ahead"))
    astray = unsplittable(F.col("line"), F.col("before") % 2 == 1) | (F.col("odds") % 2 == 1)
    return counted.select(
        *PIECE,
        "row",
        "line",
        "odd",
        "before",
        F.col("row").eqNullSafe(F.col("header")).alias("header"),
        astray.alias("astray"),
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring lines of one record as one row each: ``whole`` if nothing of the record is missing.

    Empty lines outside of records are left out.
    """
    for batch in batches:
        batch = batch.filter(pc.or_(batch.column("within"), pc.not_equal(batch.column("line"), "")))
        if not batch.num_rows:
            continue
        within, odd, row, number = (
            batch.column(c).to_numpy(zero_copy_only=False) for c in ("within", "odd", "row", "number")
        )
        opens = within & (odd == 1) & (batch.column("before").to_numpy() % 2 == 0)
        closes = within & (odd == 1) & ~opens
        new = np.ones(batch.num_rows, bool)
        new[1:] = ~within[1:] | ~within[:-1] | (np.diff(number) != 0) | (np.diff(row) != 1)
        new[_piece_begins(batch)] = True
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], batch.num_rows)
        whole = ~within[begins] | (opens[begins] & closes[ends - 1])
        lists = pa.LargeListArray.from_arrays(
            np.append(begins, batch.num_rows), batch.column("line").cast(pa.large_string())
        )
        header = np.logical_or.reduceat(batch.column("header").to_numpy(zero_copy_only=False), begins)
        first = batch.take(pa.array(begins))
        yield pa.RecordBatch.from_arrays(
            [
                *(first.column(c) for c in ("file", "number", "block", "row")),
                pa.array(header),
                pa.array(whole),
                pc.binary_join(lists, pa.scalar("\n", pa.large_string())).cast(pa.string()),
            ],
            ["file", "number", "block", "row", "header", "whole", "text"],
        )


def record_parts(lines: DataFrame) -> DataFrame:
    """Whole records of judged lines, and parts of those that a task does not see in one stretch.

    Odd lines open and close a record in turn, so half their number before a line names its record.
    """
    return lines.select(
        *PIECE,
        "row",
        "line",
        "odd",
        "before",
        "header",
        F.floor(F.col("before") / 2).alias("number"),
        ((F.col("before") % 2 == 1) | (F.col("odd") == 1)).alias("within"),
    ).mapInArrow(
        _joined,
        "file string, number long, block long, row long, header boolean, whole boolean, text string",
    )


def joined_records(parts: DataFrame) -> DataFrame:
    """Records (``record``) without headers.  Only parts of records are exchanged."""
    whole = parts.where(F.col("whole") & ~F.col("header")).select("text")
    several = (
        parts.where(~F.col("whole"))
        .groupBy("file", "number")
        .agg(
            F.array_sort(F.collect_list(F.struct("block", "row", "text"))).alias("parts"),
            F.bool_or("header").alias("header"),
        )
        .where(~F.col("header"))
        .select(F.array_join("parts.text", "\n"))
    )
    return whole.union(several).toDF("record")


def read_csv_records(
    spark: SparkSession, path: str, schema: StructType, corrupt_column: str | None = None
) -> DataFrame:
    """Rows as ``read_csv(…, multi_line=True)`` gives them, in any order, with many tasks for one file.

    The lines of a file are dealt out by its pieces.  A line's quotes are counted; the sums over the pieces
    before tell whether it begins within quotes, and so which lines make one record.  Files
    whose quotes do not tell (a quote inside an unquoted field, text after a closing one, none that closes, a
    carriage return) are found first, and read by one task each.  Lines are scanned
    once, and written to scratch as numbered and as records; what a record lacks in its task is exchanged.
    A column named ``corrupt_column`` gets the text of records that do not fit.
    """
    # Spark cuts files by the cores it has at the time: only one scan may number the lines.
    lines = write_table(numbered_lines(spark, path), scratch_path(spark, "numbered"))
    pieces = write_table(file_pieces(lines), scratch_path(spark, "pieces"))
    judged = judged_lines(lines, pieces)
    # One path per file at most, as many as the scan itself lists on the driver: fit to be broadcast.
    other = judged.where("astray").select("file").distinct()
    others = [unquote(r["file"]) for r in other.collect()]
    split = judged.join(F.broadcast(other), "file", "left_anti") if others else judged
    fields = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields]
    options = {k: v for k, v in CSV_DIALECT.items() if k not in ("header", "encoding")}
    if corrupt_column is not None:
        fields.append(f"{quoted(corrupt_column)} string")
        options["columnNameOfCorruptRecord"] = corrupt_column
    ddl = ", ".join(fields)
    parts = write_table(record_parts(split), scratch_path(spark, "records"))
    rows = joined_records(parts).select(F.from_csv("record", ddl, options).alias("r")).select("r.*")
    if others:
        rows = rows.union(read_csv(spark, others, schema, True, corrupt_column))
    return rows
