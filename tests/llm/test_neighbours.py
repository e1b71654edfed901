from __future__ import annotations

import math

import numpy as np

from strataquery.llm.neighbours import nearest
from strataquery.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, score int, block int"


def brute(rows, step, k):
    fine = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in fine:
        if i % step == 0:
            x = np.array(v)
            out[i] = sorted((-float(x @ np.array(w)) / (np.linalg.norm(x) * np.linalg.norm(w)), j) for j, w in fine if j != i)[:k]
    return out


def test_recall_on_real_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want, hits = brute(rows, 50, 5), 0
    got = {}
    for r in nearest(df, "vec_id % 50 = 0", block_rows=300).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [r for r, _, _ in sorted(got[q])] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in sorted(got[q])] == sorted((s for _, _, s in got[q]), reverse=True)
        hits += sum(s >= -best[-1][0] - 1e-9 for _, _, s in got[q])
    assert hits >= 0.9 * 5 * len(want)


def test_odd_vectors_and_equal_ones(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(40)]
    rows += [(100 + i, rows[0][1]) for i in range(30)]
    odd = [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [None] * 8), (204, [float("inf")] * 8), (205, []), (None, [1.0] * 8), (3, rows[3][1])]
    short = [(210, [1.0]), (211, [0.5, 2.0])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd + short], SCHEMA)
    rows += [(i, v + [0.0] * (8 - len(v))) for i, v in short]
    got = {}
    for r in nearest(df, "vec_id % 10 = 0").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows, 10, 5)
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [i for _, i, _ in sorted(got[q])] == [i for _, i in sorted(best, key=lambda x: (round(x[0], 9), x[1]))]
        assert np.allclose([s for _, _, s in sorted(got[q])], [-s for s, _ in best])


def test_recall_at_registered_settings(spark):
    """Two sizes, the settings of the registered query."""
    for sf, least in (("sf0.01", 0.95), ("sf0.1", 0.9)):
        df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 50, 5)
        kept = {q: -best[-1][0] - 1e-9 for q, best in want.items()}
        rows = QUERIES["op7_nearest_neighbours"](spark, f"/root/testdata/{sf}").collect()
        assert sum(r["score"] >= kept[r["query_id"]] for r in rows) >= least * 5 * len(want)


def test_tiny_and_huge_components(spark):
    df = spark.createDataFrame([(0, [-1e200, -1e200]), (1, [1.0, 0.0]), (2, [1e-200, 1e-200]), (3, [-5e-324, 0.0]), (4, [1.7e308, -1.7e308])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["score"] for r in nearest(df, "vec_id = 0").collect()}
    half = math.sqrt(0.5)
    assert got.keys() == {1, 2, 3, 4}
    assert all(abs(got[i] - x) < 1e-12 for i, x in ((1, -half), (2, -1.0), (3, half), (4, 0.0)))


def test_few_rows(spark):
    assert nearest(spark.createDataFrame([], SCHEMA), "vec_id % 50 = 0").count() == 0
    one = spark.createDataFrame([(0, [1.0, 0.0], 1, 1)], SCHEMA)
    assert nearest(one, "vec_id % 50 = 0").count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0], 1, 1), (1, [1.0, 1.0], 1, 1)], SCHEMA)
    assert [(r["vec_id"], r["rank"], round(r["score"], 9)) for r in nearest(two, "vec_id % 50 = 0").collect()] == [(1, 1, round(1 / math.sqrt(2), 9))]
