"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of an edge.

    Every round a node takes the smallest root among its neighbours, then the root of its root, so
    the rounds grow with the logarithm of a component's diameter.  Rounds are written tables.
    Edges with a NULL end are left out.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = written(pairs.union(pairs.select("y", "x")).distinct(), "edges")
    roots = written(
        both.groupBy("x").agg(F.min("y").alias("y")).selectExpr("x node", "least(x, y) root"),
        "roots",
    )
    while True:
        near = (
            both.join(roots.selectExpr("node y", "root"), "y").groupBy("x").agg(F.min("root").alias("near"))
        )
        lower = roots.join(near.withColumnRenamed("x", "node"), "node").selectExpr(
            "node", "root before", "least(root, near) root"
        )
        up = roots.selectExpr("node AS root", "root AS above")
        after = written(
            lower.join(up, "root").selectExpr("node", "before", "least(root, above) root"), "roots"
        )
        done = after.where("root <> before").isEmpty()
        roots = after.select("node", "root")
        if done:
            return roots
