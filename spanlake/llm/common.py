"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.session import scratch_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, cut from their lineage by a table in the shared scratch folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` worked out once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(items: Column, width: int) -> Column:
    """Hashes of the windows of an array of hashes, by place; none for fewer items than a window.

    ``width`` is a power of two: a window's hash is made from those of its halves, which overlapping
    windows share.
    """

    def doubled(step: int) -> Callable[[Column], Column]:
        return lambda codes: F.zip_with(
            codes,
            F.slice(codes, F.lit(step + 1), F.size(codes)),
            lambda a, b: F.xxhash64(a, b),
        )

    for k in range(width.bit_length() - 1):
        items = let(items, doubled(1 << k))
    return let(
        items, lambda c: F.slice(c, F.lit(1), F.greatest(F.size(c) - (width - 1), F.lit(0)))
    )


def bounded_sample(df: DataFrame, rows: int, *key: str | Column) -> DataFrame:
    """At most ``rows`` rows, the same ones at every run: those with the smallest key hashes.

    A threshold on the hash leaves about twice as many rows before the exact cut, so the cut
    orders a number of rows that does not grow with the table.
    """
    total = df.count()
    digest = F.xxhash64(*key)
    grain = 1 << 40
    share = min(1.0, 2.0 * rows / max(total, 1))
    near = df if share == 1.0 else df.where(F.pmod(digest, F.lit(grain)) < int(share * grain))
    return near.orderBy(F.pmod(digest, F.lit(grain)), *key).limit(rows)


def store(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path that every executor reaches, and the path within it."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches of about ``most`` characters of text; NULL texts as empty ones.

    Only the texts of one slice are Python strings at a time.
    """
    for batch in batches:
        lengths = text_lengths(batch, column)
        begin = size = 0
        for i, length in enumerate(lengths):
            size += length
            if size >= most or i + 1 == len(lengths):
                part = batch.slice(begin, i + 1 - begin)
                yield part, [t or "" for t in part.column(column).to_pylist()]
                begin, size = i + 1, 0


def text_lengths(batch: pa.RecordBatch, column: str) -> list[int]:
    """Characters of the texts of a batch; none where they are NULL."""
    return [n or 0 for n in pc.utf8_length(batch.column(column)).to_pylist()]


def sorted_groups(
    batches: Iterator[pa.RecordBatch], key: str
) -> Iterator[tuple[object, pa.Table]]:
    """Rows of each key from batches sorted by it, one key in memory at a time."""
    held: list[pa.RecordBatch] = []
    current: object = None
    for batch in batches:
        keys = batch.column(key).to_pylist()
        begin = 0
        for i in range(len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                if begin == i:
                    continue
                if held and keys[begin] != current:
                    yield current, pa.Table.from_batches(held)
                    held = []
                current = keys[begin]
                held.append(batch.slice(begin, i - begin))
                begin = i
    if held:
        yield current, pa.Table.from_batches(held)
