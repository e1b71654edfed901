"""Graphs of flat tables: nodes, edges, projections, cycles, fixpoints."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataquery.sources.shared import cut


def nodes(parts: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """id, type, label of (type, rows, key, label); ids are type:key, each once: of several rows the least label counts."""
    made = [df.select(F.concat_ws(":", F.lit(kind), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("type"), F.col(label).cast("string").alias("label")) for kind, df, key, label in parts]
    return reduce(DataFrame.unionByName, made).groupBy("id", "type").agg(F.min("label").alias("label"))


def first_nodes(parts: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """id, type, label of (type, rows, key, label), where keys are shared by all types: the first type in the order given wins."""
    made = [df.select(F.col(key).cast("string").alias("id"), F.struct(F.lit(i).alias("order"), F.col(label).cast("string").alias("label"), F.lit(kind).alias("type")).alias("row")) for i, (kind, df, key, label) in enumerate(parts)]
    return reduce(DataFrame.unionByName, made).groupBy("id").agg(F.min("row").alias("row")).select("id", "row.type", "row.label")


def core_subgraph(node_rows: DataFrame, edge_rows: DataFrame, core: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes whose id is in core (id), and the edges between two of them."""
    kept = node_rows.join(core.select("id").distinct(), "id", "left_semi")
    ends = kept.select("id")
    inside = edge_rows.join(ends.withColumnRenamed("id", "a"), "a", "left_semi").join(ends.withColumnRenamed("id", "b"), "b", "left_semi")
    return kept, inside


def collapsed_edges(edge_rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Edges (a, b, kind) with the members of groups (id, group) replaced by their group, without self-loops and repeats."""
    out = edge_rows
    for end in ("a", "b"):
        named = groups.select(F.col("id").alias(end), F.col("group").alias("__group"))
        out = out.join(named, end, "left").withColumn(end, F.coalesce("__group", end)).drop("__group")
    return out.where("a <> b").select("a", "b", "kind").distinct()


def star_edges(rows: DataFrame, group: Sequence[str], key: str, order: str) -> DataFrame:
    """a, b: the first member of each group linked to every later one."""
    first = rows.groupBy(*group).agg(F.min_by(key, F.struct(order, key)).alias("a"))
    return rows.join(first, list(group)).select(*group, "a", F.col(key).alias("b")).where("a <> b").distinct()


def incident(edge_rows: DataFrame, node: str) -> DataFrame:
    """Edges of one node, with the node at the other end."""
    return edge_rows.where((F.col("a") == node) | (F.col("b") == node)).withColumn("other", F.when(F.col("a") == node, F.col("b")).otherwise(F.col("a")))


def edges(parts: Sequence[tuple[str, DataFrame, str, str, str, str]]) -> DataFrame:
    """a, b, kind of (kind, rows, type of a, its key, type of b, its key), without self-loops and repeats."""
    made = [df.select(F.concat_ws(":", F.lit(ta), F.col(ka).cast("string")).alias("a"), F.concat_ws(":", F.lit(tb), F.col(kb).cast("string")).alias("b"), F.lit(kind).alias("kind")) for kind, df, ta, ka, tb, kb in parts]
    return reduce(DataFrame.unionByName, made).where("a <> b").distinct()


def projected_edges(steps: DataFrame, step: str, member: str, owner: str) -> DataFrame:
    """step, owner, members: which owners a step touches, through how many distinct members."""
    return steps.groupBy(step, owner).agg(F.count_distinct(member).alias("members"))


def cyclic_nodes(links: DataFrame) -> DataFrame:
    """node for every node of (a, b) that lies on or leads to a cycle: what is left when nodes without successors are taken away, again and again.

    Each round is one semi-join over the edges that are left, written to cut the lineage; rounds are the
    longest path at most.
    """
    now = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL").distinct()
    left = now.count()
    while left:
        now = cut(now.join(now.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b"))
        n = now.count()
        if n == left:
            break
        left = n
    return now.select(F.col("a").alias("node")).distinct()


def inherit(values: DataFrame, steps: DataFrame) -> DataFrame:
    """node, value: null values filled from the inputs of a step (a to b) where all inputs have one value and agree, to a fixpoint.

    Values are only ever filled, so rounds end on cyclic input too: with the first that leaves as many nulls
    as there were. They are the longest chain of nulls at most.
    """
    now = values.select("node", "value")
    open_rows = now.where("value IS NULL").count()
    while open_rows:
        per = steps.join(now, F.col("a") == F.col("node")).groupBy(F.col("b").alias("node")).agg(F.count_if(F.col("value").isNull()).alias("open"), F.min("value").alias("low"), F.max("value").alias("high"))
        given = per.where("open = 0 AND low = high").select("node", F.col("low").alias("given"))
        now = cut(now.join(given, "node", "left").select("node", F.coalesce("value", "given").alias("value")))
        n = now.where("value IS NULL").count()
        if n == open_rows:
            break
        open_rows = n
    return now
