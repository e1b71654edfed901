"""Ordered operators inside a group: carry-forward, islands, deltas, first missing, budgets."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carried(value: Column, group: Sequence[str], order: Sequence[str]) -> Column:
    """The last non-null value so far."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def islands(df: DataFrame, starts: Column, group: Sequence[str], order: Sequence[str], name: str = "island") -> DataFrame:
    """Numbers runs of rows within a group; a run begins where ``starts`` holds."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.sum(F.when(starts, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def first_missing(df: DataFrame, missing: Column, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """status: complete, running for the first missing row of a group, pending for later ones."""
    gone = missing.cast("int")
    nth = F.sum(gone).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("status", F.when(gone == 0, "complete").when(nth == 1, "running").otherwise("pending"))


def chunk_by_budget(df: DataFrame, group: str, order: str, length: str, budget: int, overhead: int = 160) -> DataFrame:
    """Adds chunk: greedy chunks of at most ``budget``, a row costing its length and the overhead; a larger row has a chunk of its own.

    A running sum that starts anew has no window form, so each group is folded by itself; its rows bound memory.
    """
    schema = df.select("*", F.lit(0).alias("chunk")).schema

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        chunk, used, out = 0, 0, []
        for n in rows[length]:
            cost = int(n) + overhead
            if used and used + cost > budget:
                chunk, used = chunk + 1, 0
            used += cost
            out.append(chunk)
        return rows.assign(chunk=pd.Series(out, index=rows.index, dtype="int32"))

    return df.groupBy(group).applyInPandas(fold, schema)


def best_of(df: DataFrame, group: Sequence[str], score: Sequence[Column], value: str) -> DataFrame:
    """The value of the row whose scores are highest, earlier scores first."""
    rank = F.struct(*[s.alias(f"s{i}") for i, s in enumerate(score)])
    return df.groupBy(*group).agg(F.max_by(value, rank).alias(value))


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by the order columns: state from a log of transitions, combined before the shuffle."""
    rest = [c for c in df.columns if c not in key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("row")
    return df.groupBy(*key).agg(best).select(*key, "row.*")
