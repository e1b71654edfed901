from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from strataquery.llm.mixing import mix, mixed_documents, source_targets
from tests.llm.conftest import texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights=(1, 2, 3), most=3):
    """Resharing until no target is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / share for s in names}
        over = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 500, "c": 2, None: 30}, {"z": 5}, {"a": 0, "b": 7, "ä": 3, "Z": 900}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([*sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 * (1 + want[s]) for s in want)


def test_odd_documents(spark, odd):
    rows = mix(odd).collect()
    size = lambda t: len(WORD.findall(t or ""))
    assert sorted(((r["doc_id"], r["size"]) for r in rows), key=repr) == sorted(((k, size(t)) for k, t in texts_of(odd)), key=repr)
    assert all(0 <= r["copies"] <= 3 for r in rows)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mix(odd.repartition(5)).collect()), key=repr)


def test_taken_words_come_near_targets(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    per = mix(df).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"))
    assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] for r in per.collect())


def test_small_fan_in_makes_a_tree(spark, small):
    per = mix(small, fan_in=4).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("m"))
    assert all(abs(r["taken"] - r["target"]) <= r["m"] for r in per.collect())


def test_rounding_is_unbiased(spark):
    """400 sources are 400 draws: each document's mean copies come near its ratio, and so do words."""
    rows = [(i, "w " * (1 + i % 5), f"s{s:03d}") for s in range(400) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    weights = [1, 2] * 200
    got = mix(df, weights=weights, trials=1, fan_in=5).groupBy((F.substring("source", 2, 3).cast("int") % 2).alias("heavy"), "doc_id").agg(F.avg("copies").alias("mean"), F.avg(F.col("target") / F.col("source_size")).alias("ratio"), F.count("*").alias("n")).collect()
    assert len(got) == 24 and {r["n"] for r in got} == {200}
    # a standard error of 0.035 at most for each mean, and of 0.007 over all of a weight
    assert all(abs(r["mean"] - r["ratio"]) < 0.13 for r in got)
    for heavy in (0, 1):
        assert abs(sum(r["mean"] - r["ratio"] for r in got if r["heavy"] == heavy) / 12) < 0.01


def test_documents_come_as_often_as_taken(spark, odd, empty):
    want = {}
    for r in mix(odd).collect():
        want[(r["doc_id"], r["source"], r["size"])] = want.get((r["doc_id"], r["source"], r["size"]), 0) + r["copies"]
    got = {}
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns
    for r in mixed.collect():
        key = (r["doc_id"], r["source"], len(WORD.findall(r["text"] or "")))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}
    assert mix(empty).count() == 0
    assert mixed_documents(empty).count() == 0
