"""Connected components of a table of links, by alternating large-star and small-star steps.

Defined results: no links give no rows; links of a node to itself, repeated and reversed links say nothing more; links with a null end say nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang neighbours on the least neighbour. Only a minimum per node is gathered."""
    near = edges.select("a", "b").union(edges.select("b", "a")) if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = near.join(least, "a")
    hung = hung.where(F.col("b") > F.col("a")) if large else hung
    out = hung.select(F.col("b").alias("x"), F.col("m").alias("y"))
    if not large:
        out = out.union(least.select("a", "m"))
    return out.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """``edges(a, b)`` of longs to a stored ``(node, root)``, a row for every node that has an edge; root is the least node."""
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}/0", folder)
    seen = None
    step = 0
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen, step = mark, step + 1
        now = stored(_star(_star(now, True), False), f"{name}/{step}", folder)
        drop(edges.sparkSession, folder, f"{name}/{step - 1}")
    # Now every edge hangs a node on its root.
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
