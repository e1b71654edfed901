from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataquery.llm.langid import Model, fit, held_out, posterior_sums, predict, train, words_of
from tests.llm.conftest import texts_of


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), train_rows=300)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = predict(docs, model).where(held_out()).select("doc_id", "lang", "lang_pred").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows) > 100


def test_odd_documents(spark, odd, model):
    got = predict(odd, model)
    assert set(got.columns) == set(odd.columns) | {"lang_pred", "score"}
    rows = got.collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1
        assert (r["score"] == 0) == (not letters)
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=repr) == sorted(texts_of(odd), key=repr)


def test_numerals_are_no_letters(spark, model):
    texts = ["\u00b2 \u00bd \u2460 \u0663", "\u2167 \u3289 12", "1a", "\u4e00\u4e8c"]
    got = [r["lang_pred"] for r in predict(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), model).orderBy("doc_id").collect()]
    assert got[:2] == ["und", "und"]
    assert "und" not in got[2:]


def test_long_runs_of_letters_are_several_words():
    assert [len(w) for w in words_of("a" * 130 + " b\u00b2c")] == [60, 60, 10, 1, 1]


def test_without_labels_everything_is_unknown(spark, odd, empty, model):
    blank = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in predict(blank, train(blank)).select("lang_pred").collect()} == {"und"}
    assert predict(empty, train(empty)).count() == 0
    assert predict(empty, model).count() == 0


def test_predictions_do_not_read_labels(spark, small, model):
    other = small.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("source", F.lit(None).cast("string"))
    key = lambda df: sorted((r["text"], r["lang_pred"], r["score"]) for r in predict(df, model).select("text", "lang_pred", "score").collect())
    assert key(small) == key(other)


def test_switched_text_gets_several_labels(spark, model):
    docs = {r["lang"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 3000").collect()}
    df = spark.createDataFrame([(1, docs["en"][:2000] + " " + docs["de"][:2000])], "doc_id long, text string")
    row = predict(df, model).collect()[0]
    assert row["lang_pred"] in ("en", "de")
    assert row["score"] < 0.75


def test_blocks_give_exact_posteriors():
    rng = np.random.default_rng(4)
    counts, a = np.array([1, 5, 64, 65, 200, 130]), rng.normal(size=(3, 3))
    e = rng.random((counts.sum(), 3)).astype(np.float32) + 0.01
    got, at = posterior_sums(e, counts, a), 0
    for k, n in enumerate(counts):
        x, alpha, beta = np.full(3, 1 / 3), [], [np.ones(3)]
        for t in range(n):
            x = (x @ np.exp(a)) * e[at + t]
            alpha.append(x := x / x.sum())
        for t in range(n - 1, 0, -1):
            b = np.exp(a) @ (e[at + t] * beta[0])
            beta.insert(0, b / b.sum())
        post = np.array(alpha) * np.array(beta)
        assert np.allclose(got[k], (post / post.sum(1, keepdims=True)).sum(0), rtol=1e-3)
        at += n


def test_training_learns_that_languages_stay():
    m = fit(["aa ab ba " * 60] * 4 + ["xy yx yy " * 60] * 4, ["p"] * 4 + ["q"] * 4)
    assert isinstance(m, Model)
    assert np.trace(m.transitions) > m.transitions.sum() - np.trace(m.transitions)
