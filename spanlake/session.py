"""Session and scratch space."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from spanlake.names import TIME_ZONE


def build_session(app: str, time_zone: str = TIME_ZONE, **conf: str) -> SparkSession:
    """Session for the jobs.

    Sizes (executors, shuffle partitions) belong to the submit command; only what the results or
    the runtime re-planning depend on is set here.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("WARN")
    return session


def scratch_root(spark: SparkSession) -> str:
    """Folder of this application's scratch tables, in ``spark.checkpoint.dir``.

    Where that is unset it lies in the warehouse folder.  A warehouse on the driver's own disk serves a local
    master only: the executors of a cluster would each write to their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        scheme = shared.split(":", 1)[0] if ":" in shared else "file"
        if scheme == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{shared}/.scratch"
    return f"{shared.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """New path for a table written to be read back."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Remove the application's scratch tables; results that still read them fail afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
