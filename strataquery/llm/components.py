"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, root: for each node of edges (a, b; longs) the smallest node that it reaches.

    Each round hangs neighbours on their smallest neighbour, larger ones first, then smaller ones; rounds end
    when nothing changes, after about as many as the logarithm of the longest path, squared at worst. Minima
    are combined before the shuffle, so a star of a third of all nodes is one row a task.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours go to the smallest of them
        large = written(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        old, now = now, written(small, "small")
        changed = not (old.exceptAll(now).isEmpty() and now.exceptAll(old).isEmpty())
        drop_written(old)
        drop_written(large)
        if not changed:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
