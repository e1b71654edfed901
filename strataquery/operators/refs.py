"""References between flat tables: bindings, dangling keys, cascading rejection with conservation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataquery.functions.numeric import ratio
from strataquery.sources.shared import cut


def dangling(refs: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Distinct keys that refs name and known lacks."""
    return refs.select(F.col(key).alias("key")).where("key IS NOT NULL").distinct().join(known.select(F.col(known_key).alias("key")), "key", "left_anti")


def binding_rates(objects: DataFrame, group: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """For each group the objects, how many have each flag, and the share (0.0 of nothing, 4 digits)."""
    counts = [F.count_if(flag).alias(name) for name, flag in flags.items()]
    rows = objects.groupBy(*group).agg(F.count("*").alias("total"), *counts)
    return rows.select(*group, "total", *flags, *[ratio(F.col(n), F.col("total"), "rate").alias(f"{n}_rate") for n in flags])


def unique_binding(labels: DataFrame, label: str, targets: DataFrame, target_label: str, target_id: str) -> DataFrame:
    """label, bound_id and status for each distinct label: resolved where one target has it, else ambiguous or unresolved."""
    per = targets.groupBy(F.col(target_label).alias("label")).agg(F.count_distinct(target_id).alias("n"), F.min(target_id).alias("id"))
    found = labels.select(F.col(label).alias("label")).distinct().join(per, "label", "left")
    status = F.when(F.col("n") == 1, "resolved").when(F.col("n") > 1, "ambiguous").otherwise("unresolved")
    return found.select("label", F.when(F.col("n") == 1, F.col("id")).alias("bound_id"), status.alias("status"))


def first_seen_ids(rows: DataFrame, key: Column, order: str, prefix: str, digits: int) -> DataFrame:
    """key, first (the least order it has) and ref_id: numbers by first appearance.

    Ids count from 1 over distinct keys: a running count of keys per range of the order, without one task for
    all rows: ranges come from a sort, their totals (one row a partition) are summed before numbering.
    """
    firsts = rows.groupBy(key.alias("key")).agg(F.min(order).alias("first"))
    # written once, so that the numbers and the totals see the same ranges
    placed = cut(firsts.orderBy("first", "key").withColumn("part", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))
    placed = placed.withColumn("own", F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
    # a row for each range
    totals = placed.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return placed.join(before, "part").select("key", "first", numbered_id(prefix, F.col("before") + F.col("own"), digits).alias("ref_id"))


def numbered_id(prefix: str, number: Column, digits: int) -> Column:
    """prefix and a number in as many digits at least; larger numbers keep all of theirs."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{digits}d", number.cast("long")))


def dedup_issues(issues: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row for each distinct key, with its first order and how often it came."""
    return issues.groupBy(*keys).agg(F.min(order).alias("first_order"), F.count("*").alias("times"))


def cascade(tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, str, str]], rejected: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Rejects rows and whatever refers to them, until nothing changes.

    tables: name to rows; links: (child, its column, parent, its key) in any order, cycles included; rejected:
    name to rows of a ``key``. A null reference is none. Rounds are the longest chain of references at most; each
    is an anti-join a link on what is left, written to cut the lineage.
    """
    keys = {parent: key for _, _, parent, key in links}
    left = {n: df.join(rejected[n].select(F.col("key").alias("__key")), F.col(keys[n]) == F.col("__key"), "left_anti") if n in rejected else df for n, df in tables.items()}
    counts = {n: df.count() for n, df in left.items()}
    moved = set(left)
    while moved:
        changed = set()
        for child in {c for c, _, p, _ in links if p in moved}:
            now = left[child]
            for _, column, parent, key in (x for x in links if x[0] == child):
                known = left[parent].select(F.col(key).alias("__key"), F.lit(True).alias("__known")).distinct()
                now = now.join(known, F.col(column) == F.col("__key"), "left").where(F.col("__known") | F.col(column).isNull()).drop("__key", "__known")
            now = cut(now)
            n = now.count()
            left[child] = now
            if n != counts[child]:
                counts[child] = n
                changed.add(child)
        moved = changed
    return left


def conservation(tables: Mapping[str, DataFrame], survivors: Mapping[str, DataFrame]) -> DataFrame:
    """object_type, input, published and rejected, which add up."""
    parts = [t.agg(F.count("*").alias("input")).crossJoin(survivors[n].agg(F.count("*").alias("published"))).select(F.lit(n).alias("object_type"), "input", "published", (F.col("input") - F.col("published")).alias("rejected")) for n, t in tables.items()]
    return reduce(DataFrame.unionByName, parts)
