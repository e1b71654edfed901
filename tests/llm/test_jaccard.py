from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from strataquery.llm import jaccard
from strataquery.llm.components import connected_components
from strataquery.llm.jaccard import near_duplicates

from tests.llm.conftest import texts_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(docs, n, percent):
    """(doc_id, n_shingles, component_id, n_links) of each row; classes whose rows have no id are linked with nothing."""
    sets = [(k, shingles(t, n)) for k, t in docs]
    names = defaultdict(lambda: None)
    for k, s in sets:
        if k is not None:
            names[s] = k if names[s] is None else min(names[s], k)
    kinds = [s for s in names if s and names[s] is not None]
    root, links = {s: s for s in kinds}, defaultdict(int)

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[find(a)] = find(b)
                links[a] += 1
                links[b] += 1
    low = {}
    for s in kinds:
        r = find(s)
        low[r] = min(low.get(r, names[s]), names[s])
    return sorted(((k, len(s), low[find(s)] if s in root else (None if s else k), links[s]) for k, s in sets), key=repr)


def rows(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80), (2, 40)])
def test_real_documents(spark, small, n, percent):
    assert rows(near_duplicates(small, n, percent)) == brute(texts_of(small), n, percent)


@pytest.mark.parametrize(("limit", "most"), [(1_000_000, 8000), (150, 3)])
def test_odd_documents(spark, odd, limit, most):
    assert rows(near_duplicates(odd, 3, 90, limit, most)) == brute(texts_of(odd), 3, 90)


def near_copies(families, copies, length, changes, seed=2):
    rng = np.random.default_rng(seed)
    docs = []
    for f in range(families):
        base = [f"f{f}w{i}" if i >= length // 2 else f"w{i}" for i in range(length)]
        for k in range(copies):
            w = list(base)
            for i in rng.choice(length, 1 + k % changes, replace=False):
                w[i] = f"x{f}_{k}_{i}"
            docs.append((len(docs), " ".join(w)))
    return docs


def test_large_regions_split(spark):
    """Many near copies of one text: regions recurse and end as pairs of blocks, and no link is lost."""
    docs = near_copies(1, 60, 80, 4)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(near_duplicates(df, 3, 80, 700)) == brute(docs, 3, 80)


@pytest.mark.parametrize(("limit", "most"), [(2500, 1000), (800, 1000), (10**6, 7), (300, 4)])
def test_levels_count_each_pair_once(spark, monkeypatch, limit, most):
    """Families that share half their words, in one region: three levels and more, with remainders."""
    monkeypatch.setattr(jaccard, "CANDIDATES", 4)
    docs = near_copies(9, 9, 60, 3, seed=5)
    sets = [(i, shingles(t, 2)) for i, t in docs]
    number = {s: k + 1 for k, s in enumerate(sorted(set().union(*(s for _, s in sets))))}
    members = [(7, i, len(s), np.sort(np.array([number[x] for x in s], np.uint64)).tobytes(), 0, 0) for i, s in sets]
    df = spark.createDataFrame(pd.DataFrame(members, columns=["region", "c", "size", "delta", "mask", "was"]), jaccard.MEMBERS)
    found = jaccard.join_regions(jaccard.written(df, "members"), 70, limit, most).collect()
    counts = defaultdict(int)
    for r in found:
        if r["n"] is not None:
            counts[r["a"]] += r["n"]
    want = brute(docs, 2, 70)
    assert [counts[i] for i, _ in docs] == [w[3] for w in sorted(want)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame([(r["a"], r["b"]) for r in found if r["b"] is not None], "a long, b long")).collect()}
    assert [roots.get(i, i) for i, _ in docs] == [w[2] for w in sorted(want)]


def test_large_signed_regions(spark, monkeypatch):
    """Regions with too many members for one comparison: pivots reach near copies, blocks of sizes the rest."""
    monkeypatch.setattr(jaccard, "SIGNED_MEMBERS", 6)
    monkeypatch.setattr(jaccard, "CANDIDATES", 4)
    docs = near_copies(4, 12, 60, 3, seed=3) + [(100 + i, "w0 w1 w2 " + " ".join(f"u{i}_{j}" for j in range(5 + i))) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(near_duplicates(df, 3, 70)) == brute(docs, 3, 70)


def test_unrelated_members_of_one_region(spark):
    """10,000 members that share one shingle alone: none links, and tasks stay small."""
    rng = np.random.default_rng(4)
    members = [(1, i, 9, np.sort(np.r_[np.uint64(5), rng.integers(10, 1 << 62, 8).astype(np.uint64)]).tobytes(), 0, 0) for i in range(10_000)]
    df = spark.createDataFrame(pd.DataFrame(members, columns=["region", "c", "size", "delta", "mask", "was"]), jaccard.MEMBERS)
    assert jaccard.join_regions(jaccard.written(df, "members"), 80, 60_000, 4000).count() == 0


def test_words_that_polynomials_confuse(spark):
    """A Thue-Morse word and its complement collide under any polynomial hash modulo 2**64."""
    docs = []
    for k in (10, 11, 12):
        t = "a"
        for _ in range(k):
            t += t.translate(str.maketrans("ab", "ba"))
        docs += [(len(docs), t), (len(docs) + 1, t.translate(str.maketrans("ab", "ba")))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(near_duplicates(df, 3, 90)) == brute(docs, 3, 90)


def test_one_id_with_two_texts(spark):
    docs = [(1, "a b c d e f g h"), (1, "q r s t u v w x"), (2, "q r s t u v w x"), (3, "a b c d e f g h")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(near_duplicates(df, 3, 90)) == brute(docs, 3, 90)


def test_empty_table(spark, empty):
    assert near_duplicates(empty).count() == 0


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}
