from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from strataquery.llm import repeats
from strataquery.llm.repeats import merge_runs, remove_repeats

from tests.llm.conftest import texts_of


def brute(docs, length):
    data = [(k, (t or "").encode()) for k, t in docs]
    seen = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for k, b in data:
        mark = np.zeros(len(b) + 1, np.int8)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = 1
        kept = bytes(np.frombuffer(b, np.uint8)[mark[:-1] == 0])
        out.append((k, len(b), int(mark.sum()), int((np.diff(np.r_[0, mark]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


# small runs and ranges, and anchors exchanged as single windows, give the same rows
@pytest.mark.parametrize(("length", "gram", "sizes"), [(200, 50, {}), (200, 50, {"run_items": 20, "range_items": 10}), (60, 20, {"hot_count": 1}), (60, 20, {"hot_count": 3, "run_items": 50})])
def test_odd_documents(spark, odd, length, gram, sizes):
    got = sorted((tuple(r) for r in remove_repeats(odd, length, gram, **sizes).collect()), key=repr)
    assert got == brute(texts_of(odd), length)


def test_real_documents(spark, small):
    got = sorted((tuple(r) for r in remove_repeats(small).collect()), key=repr)
    assert got == brute(texts_of(small), 200)


def test_overlaps_in_one_document(spark):
    docs = [(1, "ab" * 200), (2, "c" * 201), (3, "d" * 200), (4, "q" + "xyz" * 80 + "r"), (5, "s" + "xyz" * 80 + "t")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in remove_repeats(df).collect()), key=repr) == brute(docs, 200)


@pytest.mark.parametrize(("length", "gram"), [(200, 50), (12, 4)])
def test_nul_bytes(spark, length, gram):
    """Runs of NUL bytes, which padding must not be taken for."""
    rng = np.random.default_rng(6)
    pieces = ["\0" * 60, "\0" * 7, "ab\0", "\0c" * 30, "xyz" * 20, "\0" * 130]
    docs = [(i, "".join(pieces[j] for j in rng.integers(0, 6, rng.integers(1, 9)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in remove_repeats(df, length, gram).collect()), key=repr) == brute(docs, length)


def test_rows_that_move_between_evaluations(spark, small):
    """Rows are named by what they hold, so a shuffled input is fine."""
    moved = small.select("doc_id", "text").repartition(3)
    assert sorted((tuple(r) for r in remove_repeats(moved).collect()), key=repr) == brute(texts_of(small), 200)


def test_ranges_are_shared_out(spark, small, monkeypatch):
    monkeypatch.setattr(repeats, "SPLITTER_SAMPLE", 3)
    assert sorted((tuple(r) for r in remove_repeats(small, range_items=20).collect()), key=repr) == brute(texts_of(small), 200)


def test_empty_table(spark, empty):
    assert remove_repeats(empty).count() == 0


def test_kept_bytes_come_back(spark):
    df = spark.createDataFrame([(1, "a" * 150 + "é" * 10)], "doc_id long, text string")
    assert bytes(remove_repeats(df, keep_bytes=True).collect()[0]["kept"]).decode() == "a" * 150 + "é" * 10


def test_merge_orders_runs_and_knows_common_prefixes():
    rng = np.random.default_rng(5)
    runs = []
    for _ in range(7):
        s = sorted(bytes(rng.integers(97, 99, rng.integers(0, 12)).astype(np.uint8)) for _ in range(rng.integers(0, 40)))
        common = [0] + [next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))) for a, b in zip(s, s[1:], strict=False)]
        runs.append((s, common[: len(s)]))
    run, at, lcp = merge_runs(runs)
    got = [runs[r][0][i] for r, i in zip(run, at, strict=True)]
    assert got == sorted(x for s, _ in runs for x in s)
    assert lcp[1:] == [next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b))) for a, b in zip(got, got[1:], strict=False)]
