"""Alignment of found values with reference values, one to one, and its measures."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataquery.functions.numeric import f1_metrics

PAIRS = "group_id long, name string, truth_id long, found_id long, status string"


def _fits(a: tuple, b: tuple) -> bool:
    """Whether two (id, low, high, unit) agree: equal units where both have one, and intervals that overlap."""
    if a[1] is None or b[1] is None or (a[3] and b[3] and a[3] != b[3]):
        return False
    slack = max(1e-6, 0.01 * abs(a[1]), 0.01 * abs(b[1]))
    return a[1] <= b[2] + slack and b[1] <= a[2] + slack


def _pair(left: list[tuple], right: list[tuple]) -> Iterator[tuple[int | None, int | None, str]]:
    for t in left:
        fit = next((f for f in right if _fits(t, f)), None)
        pick = fit or next(iter(right), None)
        if pick:
            right.remove(pick)
        yield t[0], pick[0] if pick else None, "matched" if fit else "value_diff" if pick else "truth_only"
    yield from ((None, f[0], "found_only") for f in right)


def align(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of (group_id, id, name, low, high, unit) rows: each truth row, by id, takes the first open found row of its name whose value fits, else the first of its name; what is left on either side stands alone.

    The choice depends on order, so rows of one (group_id, name) are folded by themselves: both sides meet in
    one shuffle, sorted, and a task streams through its groups; the largest group bounds its memory.
    """
    columns = ["group_id", "name", "side", "id", "low", "high", "unit"]
    both = truth.withColumn("side", F.lit(0)).select(columns).union(found.withColumn("side", F.lit(1)).select(columns))
    dealt = both.repartition("group_id", "name").sortWithinPartitions("group_id", "name", "side", "id")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out: list[tuple] = []
        for key, group in groupby(rows, lambda r: r[:2]):
            sides: tuple[list, list] = ([], [])
            for r in group:
                sides[r[2]].append(r[3:])
            out += [(*key, *p) for p in _pair(*sides)]
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return dealt.mapInArrow(fold, PAIRS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    columns = [*zip(*rows, strict=True)] or [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [x.split()[0] for x in PAIRS.split(", ")])


def measures(pairs: DataFrame, *group: str) -> DataFrame:
    """Counts by status, precision, recall and F1 for each group (of all without one)."""
    names = ("matched", "value_diff", "truth_only", "found_only")
    counts = pairs.groupBy(*group).agg(*[F.count_if(F.col("status") == n).alias(n) for n in names])
    return counts.select(*group, *names, *f1_metrics(*[F.col(n) for n in names]))


def evaluate_labels(rows: DataFrame, truth: str, predicted: str, *group: str) -> DataFrame:
    """tp, fp, fn, abstentions, precision, recall, f1 of 0/1 predictions; a null prediction abstains."""
    t, p = F.col(truth) == 1, F.col(predicted) == 1
    counts = rows.groupBy(*group).agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~F.coalesce(p, F.lit(False))).alias("fn"), F.count_if(F.col(predicted).isNull()).alias("abstained"))
    zero = F.lit(0)
    return counts.select("*", *f1_metrics(F.col("tp"), zero, F.col("fn"), F.col("fp")))
