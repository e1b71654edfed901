from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np

from strataquery.llm.topk import BitSlices, exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score int, rank int"


def brute(rows, k, step):
    fine = [(i, np.floor(64 * np.array(v, np.float64))) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, x in fine:
        if q % step == 0:
            best = sorted((-sum(int(a) * int(b) for a, b in zip(x, y, strict=False)), i) for i, y in fine if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [float("nan")] * 6), (103, [float("inf")] * 6), (None, [1.0] * 6), (104, []), (105, [0.5]), (106, rows[0][1]), (107, rows[0][1]), (108, [0.0] * 6), (109, [-0.001] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA).repartition(3)
    got = {tuple(r) for r in exact_top_k(df, "vec_id % 4 = 0", k=5, block_rows=20, query_rows=7).collect()}
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == brute(rounded, 5, 4)


def test_repeated_rows_are_candidates_once_each(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1, 1), (1, [1.0, 0.0], 1, 1), (1, [1.0, 0.0], 1, 1), (2, [0.0, 1.0], 1, 1)], SCHEMA)
    assert Counter((r["query_id"], r["vec_id"]) for r in exact_top_k(df, "vec_id = 0", k=3).collect()) == {(0, 1): 2, (0, 2): 1}


def test_empty_table(spark):
    assert exact_top_k(spark.createDataFrame([], SCHEMA), "vec_id % 20 = 0").count() == 0


def test_slices_add_exactly():
    rng = np.random.default_rng(3)
    values = rng.integers(-900, 900, (333, 9))
    slices = BitSlices.load(BitSlices(values).dump())
    slices.with_complements()
    for _ in range(20):
        q = rng.integers(-300, 300, 9)
        parts, above = slices.scores(q)
        got = np.full(333, above)
        for c, s in enumerate(parts):
            got += np.unpackbits(s.view(np.uint8), bitorder="little")[:333].astype(np.int64) << c
        assert (got == values @ q).all()


def test_ranks_start_at_one(spark):
    df = spark.createDataFrame([(i, [float(i % 3), 1.0], 0, 0) for i in range(30)], SCHEMA)
    ranks = defaultdict(list)
    for r in exact_top_k(df, "vec_id % 10 = 0", k=4).collect():
        ranks[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
    assert all([x[0] for x in sorted(v)] == [1, 2, 3, 4] and sorted(v) == sorted(v, key=lambda x: x[1:]) for v in ranks.values())


def test_large_components_are_exact(spark):
    """Beyond 2**28 and up to the end of longs; scores beyond a long are the nearest long, in their true order."""
    df = spark.createDataFrame([(0, [1.0, 1.0]), (1, [5e6, 0.0]), (2, [6e6, 1.0]), (3, [-5e15, 2.0]), (4, [1e14, -1e14]), (5, [1e300, 0.0])], "vec_id long, embedding array<double>")
    got = [(r["vec_id"], r["score"]) for r in exact_top_k(df, "vec_id = 0", k=9).orderBy("rank").collect()]
    floors = {1: (320000000, 0), 2: (384000000, 64), 3: (-320000000000000000, 128), 4: (6400000000000000, -6400000000000000)}
    want = {i: 64 * (a + b) for i, (a, b) in floors.items()}
    want[3] = max(want[3], -(2**63))
    assert got == [(5, 2**63 - 1), *sorted(want.items(), key=lambda x: (-x[1], x[0]))]


def test_rows_of_one_id_ask_once(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [3.0, 1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in exact_top_k(df, "vec_id = 0", k=2).orderBy("rank").collect()] == [(0, 1, 2, 8192), (0, 2, 1, 4096)]
