"""URL filters as a sort-merge range join of hosts with nested rules.

The labels of a host are reversed, so a rule's host and all its subdomains are one interval of
keys: those that begin with the rule's key.  Urls and rules are dealt out by key range, a rule to
every range that its interval meets, and each range is swept in order with a stack of the rules
whose interval is open.  Of the open rules whose path the url's path starts with, the longest
(host and path together) wins, then the one with the longer host; ``block`` wins over ``allow``.

A url that is NULL or has no ``://`` has an empty host and path, and no rule.  A rule without a host
or verdict is left out, one without a path fits every path.  Repeated urls are all kept.  Empty
tables of urls or of rules are fine.  Columns of the input that are called like a result are
replaced; working columns take names that the input does not have.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanlake.llm.common import bounded_sample

SAMPLE_ROWS = 20_000
"""Urls, at most, from which the ranges are taken; they only balance the tasks."""

BEYOND = "\U0010ffff"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; ASCII letters in lower case."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(name: Column) -> Column:
    """Labels in reverse order, each closed by a dot; empty for no host."""
    return F.when(name == "", "").otherwise(
        F.concat(F.array_join(F.reverse(F.split(name, r"\.", -1)), "."), F.lit("."))
    )


@dataclass
class Open:
    """Rules of one host whose interval the sweep is in."""

    key: str
    paths: dict[str, tuple[str, str]] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)

    def add(self, rule_path: str, name: str, verdict: str) -> None:
        known = self.paths.get(rule_path)
        if known is None or verdict == "block":
            self.paths[rule_path] = (name + rule_path, verdict)
        self.sizes = sorted({len(p) for p in self.paths}, reverse=True)

    def longest(self, url_path: str) -> tuple[str, str] | None:
        for size in self.sizes:
            if size <= len(url_path) and (found := self.paths.get(url_path[:size])):
                return found
        return None


def judge(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Input rows with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has the columns ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).
    """
    made = ("host", "path", "rule", "verdict")
    kept = [f for f in urls.schema.fields if f.name not in made]
    names = [f.name for f in kept]
    part, key, kind = "_part", "_key", "_kind"
    while {part, key, kind} & set(names):
        part, key, kind = part + "_", key + "_", kind + "_"

    keyed = urls.select(
        *[F.col(f"`{n}`") for n in names],
        host(F.col(url)).alias("host"),
        path(F.col(url)).alias("path"),
        F.lit(1).alias(kind),
        F.lit(None).cast("string").alias("verdict"),
    ).withColumn(key, host_key(F.col("host")))
    simple = [f.name for f in kept if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.lpad(F.hex(F.xxhash64(*[F.col(f"`{n}`") for n in simple])), 16, "0")
    # The salt splits a url that holds many rows.
    place = F.concat_ws("\x00", key, "path", salt)
    tasks = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(keyed.select(place.alias("p")), 4 * tasks)

    known = rules.select(
        F.translate("host", UPPER, LOWER).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        F.lit(0).alias(kind),
        "verdict",
    ).where("host <> '' AND verdict IN ('allow', 'block')")
    known = known.withColumn(key, host_key(F.col("host")))

    def parts_of_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [bisect_right(bounds, p) for p in batch.column("_place").to_pylist()]
            columns = [n for n in batch.schema.names if n != "_place"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in columns), pa.array(found, pa.int32())], [*columns, part]
            )

    def parts_of_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(key).to_pylist()
            spans = [(bisect_right(bounds, k), bisect_right(bounds, k + BEYOND)) for k in keys]
            rows = [i for i, (a, b) in enumerate(spans) for _ in range(a, b + 1)]
            found = [p for a, b in spans for p in range(a, b + 1)]
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(found, pa.int32())], [*batch.schema.names, part]
            )

    def dealt(df: DataFrame, deal) -> DataFrame:
        fields = [f for f in df.schema.fields if f.name != "_place"]
        schema = T.StructType([*fields, T.StructField(part, T.IntegerType())])
        return df.mapInArrow(deal, schema)

    swept = (
        dealt(keyed.withColumn("_place", place), parts_of_urls)
        .unionByName(dealt(known, parts_of_rules), allowMissingColumns=True)
        .repartition(tasks, part)
        .sortWithinPartitions(part, key, kind)
    )

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[Open] = []
        current = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (part, key, kind, "host", "path", "verdict")]
            rows, rule, verdict = [], [], []
            for i, (p, k, is_url, name, url_path, says) in enumerate(zip(*columns)):
                if p != current:
                    current, stack = p, []
                while stack and not k.startswith(stack[-1].key):
                    stack.pop()
                if not is_url:
                    if not stack or stack[-1].key != k:
                        stack.append(Open(k))
                    stack[-1].add(url_path, name, says)
                    continue
                best = None
                for entry in stack:  # from the shortest host to the longest
                    found = entry.longest(url_path)
                    if found and (best is None or len(found[0]) >= len(best[0])):
                        best = found
                rows.append(i)
                rule.append(best[0] if best else None)
                verdict.append(best[1] if best else default)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    *(taken.column(n) for n in [*names, "host", "path"]),
                    pa.array(rule, pa.string()),
                    pa.array(verdict, pa.string()),
                ],
                [*names, *made],
            )

    return swept.mapInArrow(
        sweep,
        T.StructType(
            [T.StructField(f.name, f.dataType) for f in kept]
            + [T.StructField(c, T.StringType()) for c in made]
        ),
    )


def _bounds(places: DataFrame, parts: int) -> list[str]:
    """Lower ends of the ranges after the first, from a bounded sample."""
    rows = bounded_sample(places, SAMPLE_ROWS, "p").toArrow().column("p").to_pylist()
    rows.sort()
    return sorted({rows[i * len(rows) // parts] for i in range(1, parts)}) if rows else []
