"""Layers that are published whole: immutable version folders and a pointer to the current one.

A run writes its tables, each once, into a new folder below ``versions`` and a manifest with their
schemas.  Publishing replaces the small file ``CURRENT`` by a rename; until then, and if the run fails or is
killed, readers get the version before.  A reader looks the pointer up once and so sees the tables of
one run only.  Older versions are removed when a newer one is published, but for the last ones, which
readers that began earlier may still use.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from spanlake.plans.layout import inside

VERSIONS, POINTER, MANIFEST, TABLE = "versions", "CURRENT", "_manifest.json", "table"

KEPT = 2
"""Published versions before the current one that stay."""


class Folder:
    """Files below a path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str) -> JavaObject:
        return self.jvm.org.apache.hadoop.fs.Path(inside(self.root, name) if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, name: str) -> list[str]:
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name)))

    def state(self, name: str) -> list[list]:
        """Name, length and time of change of a file, or of the files of a folder."""
        found = self.fs.listStatus(self.path(name))
        return sorted([s.getPath().getName(), s.getLen(), s.getModificationTime()] for s in found)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Replace a small file; who reads it gets the old text or the new one."""
        draft = f"{name}-{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        how[0] = options.OVERWRITE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path("").toUri(), self.conf)
        context.rename(self.path(draft), self.path(name), how)

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


@dataclass(frozen=True)
class Version:
    """The tables of one run."""

    spark: SparkSession
    root: str
    schemas: dict[str, StructType] | None
    """None for a layer that was not published by versions: its tables lie right below the root."""
    name: str = ""
    note: dict = field(default_factory=dict)
    """What the run that published it noted about itself."""

    def path(self, table: str) -> str:
        return inside(self.root, table if self.schemas is None else f"{TABLE}={table}")

    def read(self, table: str) -> DataFrame:
        if self.schemas is None:
            return self.spark.read.parquet(self.path(table))
        return self.spark.read.schema(self.schemas[table]).parquet(self.path(table))


def current(spark: SparkSession, layer: str) -> Version:
    """The published version of a layer."""
    folder = Folder(spark, layer)
    if not folder.exists(POINTER):
        return Version(spark, layer, None)
    name = folder.read(POINTER)
    root = f"{VERSIONS}/{name}"
    known = json.loads(folder.read(f"{root}/{MANIFEST}"))
    schemas = {t: StructType.fromJson(s) for t, s in known["tables"].items()}
    return Version(spark, inside(layer, root), schemas, name, known["note"])


def read_current(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """One table of the published version; several should be read through one :func:`current`."""
    return current(spark, layer).read(table)


@dataclass
class Draft:
    """A version that is being written; as context it is removed unless it was published."""

    spark: SparkSession
    layer: str
    name: str = field(default_factory=lambda: f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    schemas: dict[str, StructType] = field(default_factory=dict)
    published: bool = False

    @property
    def version(self) -> Version:
        return Version(self.spark, inside(self.layer, f"{VERSIONS}/{self.name}"), self.schemas)

    def path(self, table: str) -> str:
        return self.version.path(table)

    def added(self, table: str, schema: StructType) -> DataFrame:
        """The table that was written to its path, as read back."""
        self.schemas[table] = schema
        if not Folder(self.spark, self.version.root).exists(f"{TABLE}={table}"):
            self.spark.createDataFrame([], schema).write.parquet(self.path(table))
        return self.version.read(table)

    def write(self, df: DataFrame, table: str) -> DataFrame:
        df.write.parquet(self.path(table))
        return self.added(table, df.schema)

    def write_split(self, df: DataFrame, tables: dict[str, Iterable[str]]) -> dict[str, DataFrame]:
        """One pass over rows whose column ``table`` names the table they belong to.

        ``tables`` gives each table's columns; rows of other tables are stored, but not part of the version.
        """
        df.write.mode("append").partitionBy(TABLE).parquet(self.version.root)
        return {
            table: self.added(table, StructType([df.schema[c] for c in columns]))
            for table, columns in tables.items()
        }

    def publish(self, note: dict | None = None, keep: int = KEPT) -> None:
        folder = Folder(self.spark, self.layer)
        tables = {t: s.jsonValue() for t, s in self.schemas.items()}
        folder.write(f"{VERSIONS}/{self.name}/{MANIFEST}", json.dumps({"tables": tables, "note": note or {}}))
        folder.write(POINTER, self.name)
        self.published = True
        older = [v for v in folder.names(VERSIONS) if v < self.name]
        whole = [v for v in older if folder.exists(f"{VERSIONS}/{v}/{MANIFEST}")]
        for v in set(older) - set(whole[max(0, len(whole) - keep) :]):
            folder.remove(f"{VERSIONS}/{v}")

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if not self.published:
            Folder(self.spark, self.layer).remove(f"{VERSIONS}/{self.name}")
