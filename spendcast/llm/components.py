"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum and a join over the edge table, written to the
shared folder; the driver only learns whether the edges still change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pin


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges``: distinct (x, y) with x > y.  Large star: hang each node's
    greater neighbours on the smallest node around it; small star: the same for
    its smaller neighbours and itself."""
    if large:
        around = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
    else:
        around = edges
    least = pin(around.groupBy("x").agg(F.min("y").alias("m")).withColumn("m", F.least("x", "m")))
    hung = around.join(least, "x")
    if large:
        out = hung.where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y"))
    else:
        out = hung.where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(
            least.select("x", F.col("m").alias("y")))
    return pin(out.where("x <> y").distinct())


def components(links: DataFrame) -> DataFrame:
    """``links``: (x, y) in any order.  Returns (node, component): the smallest
    node that each node of a link can reach."""
    edges = pin(links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x <> y").distinct())
    while True:
        after = _star(_star(edges, True), False)
        changed = after.join(edges, ["x", "y"], "left_anti").limit(1).count() + edges.join(after, ["x", "y"], "left_anti").limit(1).count()
        edges = after
        if not changed:
            break
    roots = edges.select(F.col("y").alias("node"), F.col("y").alias("component")).distinct()
    return edges.select(F.col("x").alias("node"), F.col("y").alias("component")).unionByName(roots)
