from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strataquery.llm.packing import WordCache, pack, piece_bounds, plan_best_fit, tokenize
from tests.llm.conftest import texts_of

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(rows, docs, tokenizer, capacity):
    """Every document's pieces have its ids, and sequences are gapless and not over full."""
    want = []
    for k, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        first = len(ids) - capacity * ((len(ids) - 1) // capacity)
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(k, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows), key=repr) == sorted(want, key=repr)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("capacity", [1024, 50])
def test_odd_documents(spark, odd, tokenizer, capacity):
    rows = pack(tokenize(odd, PATH, capacity), capacity).collect()
    check(rows, texts_of(odd), tokenizer, capacity)


def test_real_documents_fill_sequences(spark, small, tokenizer):
    rows = pack(tokenize(small, PATH)).collect()
    n = check(rows, texts_of(small), tokenizer, 1024)
    assert n <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


def test_ids_on_demand_and_empty_table(spark, empty, tokenizer):
    df = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert tokenize(df, PATH, keep_ids=True).collect()[0]["ids"] == [*tokenizer.encode("some text", add_special_tokens=False).ids, 2]
    assert pack(tokenize(empty, PATH)).count() == 0


PARTS = [*"ab1.,' \n\t\0é漢\u3000 <|>", "<|endoftext|>", "don't"]


@settings(deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=30).map("".join), min_size=1, max_size=6))
def test_cached_words_give_the_tokenizers_ids(texts):
    cache = CACHES.setdefault("one", WordCache(PATH, most=40))
    assert [list(x) for x in cache.ids(pa.array(texts))] == [e.ids for e in cache.tokenizer.encode_batch(texts, add_special_tokens=False)]


CACHES: dict[str, WordCache] = {}


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
def test_plan_places_every_rank_once(counts):
    used, seen = {}, {n: [] for n in counts}
    for length, rank, ranks, each, first, at in plan_best_fit(counts, 40):
        for t in range(ranks):
            seen[length].append(rank + t)
            used.setdefault(first + t // each, []).append((at + t % each * length, length))
    assert all(sorted(v) == list(range(counts[n])) for n, v in seen.items())
    for parts in used.values():
        end = 0
        for a, n in sorted(parts):
            assert a == end
            end += n
        assert end <= 40


def test_only_long_documents_are_cut():
    assert piece_bounds(1024, 1024) == [(0, 1024)]
    assert piece_bounds(1025, 1024) == [(0, 1), (1, 1024)]
    assert piece_bounds(2048, 1024) == [(0, 1024), (1024, 1024)]
