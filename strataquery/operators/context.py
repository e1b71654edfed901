"""What of a document goes into a step: blocks by section, by reference, by type, within a budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def section_tiers(blocks: DataFrame, tiers: Sequence[Sequence[str]]) -> DataFrame:
    """Blocks of a document's first tier of sections that has any (all others are the last tier), with their tier; tier 0 needs no warning."""
    order = F.coalesce(*[F.when(F.col("section").isin(*names), F.lit(i)) for i, names in enumerate(tiers)], F.lit(len(tiers)))
    best = F.min("tier").over(Window.partitionBy("document_id"))
    return blocks.withColumn("tier", order).withColumn("best", best).where("tier = best").drop("best")


def select_context(blocks: DataFrame, referenced: DataFrame, sections: Sequence[str], overhead: int, always: Column | None = None, fallback: Column | None = None) -> DataFrame:
    """Blocks (document_id, block_id, section, text, ..) that are not empty and whose section is asked for, that are referenced (document_id, block_id) or that hold ``always``, each with ``reason`` and ``cost``.

    In a document without any block of the sections those that hold ``fallback`` come too. The cost of a block is its
    length and an overhead.
    """
    refs = referenced.select("document_id", "block_id", F.lit(True).alias("__ref")).distinct()
    rows = blocks.join(refs, ["document_id", "block_id"], "left")
    by_section = F.col("section").isin(*sections)
    some = F.max(by_section.cast("int")).over(Window.partitionBy("document_id"))
    reason = F.when(by_section, "section").when(F.col("__ref"), "reference")
    if always is not None:
        reason = reason.when(always, "always")
    if fallback is not None:
        reason = reason.when((F.coalesce(F.col("__some"), F.lit(0)) == 0) & fallback, "fallback")
    rows = rows.withColumn("__some", some).withColumn("reason", reason).withColumn("cost", F.length("text") + F.lit(overhead))
    return rows.where("reason IS NOT NULL AND trim(text) <> ''").drop("__ref", "__some")


def over_budget(context: DataFrame, budget: int) -> DataFrame:
    """document_id, cost of documents whose context costs more than the budget."""
    return context.groupBy("document_id").agg(F.sum("cost").alias("cost")).where(F.col("cost") > budget)


def unknown_references(referenced: DataFrame, blocks: DataFrame) -> DataFrame:
    return referenced.select("document_id", "block_id").distinct().join(blocks.select("document_id", "block_id"), ["document_id", "block_id"], "left_anti")


def complement(everything: DataFrame, key: Sequence[str], *taken: DataFrame) -> DataFrame:
    """The keys of a table that none of the others has."""
    left = everything.select(*key).distinct()
    for other in taken:
        left = left.join(other.select(*key).distinct(), list(key), "left_anti")
    return left


def overlap(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys in both tables: what must not be."""
    return a.select(*key).distinct().join(b.select(*key), list(key), "left_semi")


def first_offenders(values: DataFrame, value: str, allowed: DataFrame, n: int = 5) -> DataFrame:
    """offenders (the first n in order) and how many distinct values are not allowed."""
    wrong = values.select(F.col(value).alias("v")).distinct().join(allowed.select(F.col(value).alias("v")), "v", "left_anti")
    first = wrong.orderBy("v").limit(n).agg(F.array_sort(F.collect_list("v")).alias("offenders"))
    return first.crossJoin(wrong.agg(F.count("*").alias("n_offenders")))


def held_by_all(members: DataFrame, group: Sequence[str], owner: str, value: str) -> DataFrame:
    """Values that every owner of a group has."""
    owners = members.groupBy(*group).agg(F.count_distinct(owner).alias("owners"))
    per = members.groupBy(*group, value).agg(F.count_distinct(owner).alias("having"))
    return per.join(owners, list(group)).where("having = owners").select(*group, value)


def supersets(sets: DataFrame, key: str, values: str) -> DataFrame:
    """For each set the one that holds it strictly and is the largest such, where there is just one: (key, superset).

    Sets meet on one of their values alone, the rarest, so a common value does not bring all together.
    """
    flat = sets.select(key, F.explode(F.array_distinct(values)).alias("v"))
    often = flat.groupBy("v").agg(F.count("*").alias("n"))
    probe = flat.join(often, "v").groupBy(key).agg(F.min_by("v", F.struct("n", "v")).alias("v"))
    met = probe.join(flat.withColumnRenamed(key, "superset"), "v").where(F.col(key) != F.col("superset")).select(key, "superset")
    own = sets.select(key, F.array_distinct(values).alias("own"))
    other = sets.select(F.col(key).alias("superset"), F.array_distinct(values).alias("other"))
    held = met.join(own, key).join(other, "superset").where((F.size(F.array_except("own", "other")) == 0) & (F.size("other") > F.size("own")))
    ranked = held.withColumn("size", F.size("other")).groupBy(key).agg(F.max_by("superset", "size").alias("superset"), F.max("size").alias("most"), F.collect_list("size").alias("sizes"))
    return ranked.where(F.size(F.filter("sizes", lambda x: x == F.col("most"))) == 1).select(key, "superset")
