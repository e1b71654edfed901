"""The stages over odd and real documents: columns, decisions, what stays."""

from __future__ import annotations

import pytest

import corpus_pipeline as pipeline
from strataquery.llm.common import written
from tests.llm.test_jaccard import shingles

SF = "/root/testdata/sf0.001"


def documents(df):
    return df.select(*pipeline.COLUMNS)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES[:-1]])
def test_stages_return_documents(spark, odd, empty, name):
    stage = dict(pipeline.STAGES)[name]
    assert stage(spark, odd, SF).columns == list(pipeline.COLUMNS)
    assert stage(spark, documents(empty), SF).count() == 0


def test_language_keeps_clean_documents(spark, small):
    kept = pipeline.language(spark, small, SF)
    gone = documents(small).subtract(kept).collect()
    assert all(not any(c.isalpha() for c in r["text"] or "") for r in gone)


def test_lines_keep_one_of_what_recurs(spark, small):
    before = {line for r in small.collect() for line in (r["text"] or "").split("\n")}
    rows = pipeline.lines(spark, small, SF).collect()
    assert {line for r in rows for line in r["text"].split("\n")} >= {x for x in before if len(x.split(" ")) < 3}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_near_keeps_one_of_each_group(spark, small):
    rows = pipeline.near(spark, small, SF).collect()
    sets = [(r["doc_id"], shingles(r["text"], 5)) for r in rows]
    for i, (_, a) in enumerate(sets):
        for _, b in sets[:i]:
            both = len(a & b)
            assert not both or 100 * both < 80 * (len(a) + len(b) - both)
    stay = {k for k, _ in sets}
    for r in small.collect():
        if r["doc_id"] not in stay:
            a = shingles(r["text"], 5)
            assert any(len(a & shingles(x["text"], 5)) for x in rows)


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = sorted(tuple(r) for r in docs.select(key).collect())
    assert sorted(tuple(r) for r in pipeline.run(spark, SF).select(key).collect()) == want
    assert len(want) > 0
