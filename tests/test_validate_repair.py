"""Rules in both modes, and rewrites with their counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataquery.operators import repair, validate


def tables(spark):
    return {
        "properties": spark.createDataFrame([("d", "p1", "s1", 1.0, 2.0), ("d", "p2", "s9", 3.0, 2.0), ("e", "p1", None, None, None), ("e", "p1", "s1", 1.0, 1.0)], "document_id string, property_id string, sample_id string, low double, high double"),
        "samples": spark.createDataFrame([("d", "s1"), ("e", "s1")], "document_id string, sample_id string"),
    }


def test_modes_and_verdicts(spark):
    t = tables(spark)
    rules = [validate.Rule("range_reversed", "properties", "property_id", F.col("low") <= F.col("high"), relaxed=True)]
    refs = [validate.Reference("unknown_sample", "properties", "property_id", "sample_id", "samples", "sample_id")]
    for mode, severity in (("strict", "error"), ("preview", "warning")):
        found = validate.issues([*validate.check_rules(t, rules, mode), *validate.check_references(t, refs, mode), validate.check_unique(t["properties"], "property_id", "duplicate_id")])
        got = {(r["document_id"], r["code"], r["object_id"], r["severity"]) for r in found.collect()}
        assert got == {("d", "range_reversed", "p2", severity), ("d", "unknown_sample", "p2", "error"), ("e", "duplicate_id", "p1", "error")}
        docs = spark.createDataFrame([("d",), ("e",), ("f",)], "document_id string")
        assert {r["document_id"]: r["status"] for r in validate.verdicts(docs, found).collect()} == {"d": "failed", "e": "failed", "f": "passed"}


def test_checks(spark):
    row = spark.range(1).select(
        validate.scope_holds(F.lit("resolved"), F.lit("s"), F.lit(None).cast("array<string>")).alias("a"),
        validate.scope_holds(F.lit("multi_resolved"), F.lit(None), F.array(F.lit("s"), F.lit("s"))).alias("b"),
        validate.coverage_holds(F.lit(5), F.lit(3), F.lit(1), F.lit(1), F.lit(0.75)).alias("c"),
        validate.totals_hold(F.lit(7), F.lit(3), F.lit(None), F.lit(4)).alias("d"),
    ).collect()[0]
    assert tuple(row) == (True, False, True, True)


def test_quality_metrics_count_nothing_as_complete(spark):
    t = tables(spark)["properties"]
    got = validate.quality_metrics(t, {"bound": (F.lit(True), F.col("sample_id").isNotNull()), "none": (F.lit(False), F.lit(True))}).collect()
    assert {(r["metric"], r["complete"], r["total"], r["ratio"]) for r in got} == {("bound", 3, 4, 0.75), ("none", 0, 0, 1.0)}


def test_repairs_count_what_they_change(spark):
    rows = spark.createDataFrame([("d", "Tg", " ", "c", None), ("d", "350", "350", None, None), ("e", "Mn", "5", "c", "k")], "document_id string, name string, value string, code string, category string")
    out, counts = repair.in_order(rows, [repair.rewrite("blank_value", "value", F.trim("value") == "", F.lit(None)), repair.drop_rows("name_is_value", F.col("name") == F.col("value")), repair.clear_partial("partial_triple", ["code", "category"])])
    assert {tuple(r) for r in out.collect()} == {("d", "Tg", None, None, None), ("e", "Mn", "5", "c", "k")}
    assert {tuple(r) for r in counts.collect()} == {("d", "blank_value", 1), ("d", "name_is_value", 1), ("d", "partial_triple", 1)}


def test_step_repairs(spark):
    steps = spark.createDataFrame([("d", "a", ["x", "y", "x"], ["y", "z"]), ("d", "b", ["q"], ["z"])], "document_id string, step string, inputs array<string>, outputs array<string>")
    cleaned, n = repair.drop_overlap("overlap", "inputs", "outputs")(steps)
    assert {r["step"]: r["inputs"] for r in cleaned.collect()} == {"a": ["x"], "b": ["q"]}
    assert n.collect()[0]["n"] == 1
    kept, n = repair.single_producer("producers", steps, "step", "outputs")
    assert {r["step"]: r["outputs"] for r in kept.collect()} == {"a": ["y"]}
    assert n.collect()[0]["n"] == 1


def test_ids_are_renumbered_and_remapped(spark):
    rows = repair.renumber(spark.createDataFrame([("d", 5, "old5"), ("d", 2, "old2")], "document_id string, at int, id string"), "at", "prop")
    refs = spark.createDataFrame([("d", ["old5", "other", "old2"]), ("e", [])], "document_id string, ids array<string>")
    assert {r["document_id"]: r["ids"] for r in repair.remap(refs, "ids", rows, "id", "new_id").collect()} == {"d": ["prop002", "other", "prop001"], "e": []}


def test_confidence_vocabulary_and_blends(spark):
    series = spark.createDataFrame([("d", "s", None)], "document_id string, series_id string, score double")
    points = spark.createDataFrame([("d", "s", 0.9), ("d", "s", None), ("d", "s", 0.7)], "document_id string, series_id string, score double")
    a, b = repair.inherit_confidence(series, points)
    assert a.collect()[0]["score"] == 0.7
    assert sorted(r["score"] for r in b.collect()) == [0.5, 0.7, 0.9]
    words = spark.createDataFrame([("c1", "Tg"), ("c2", "Mn"), ("c2", "Mw")], "code string, name string")
    rows = spark.createDataFrame([("c1", None), ("c2", None), ("c1", "own")], "code string, name string")
    assert sorted((r["code"], r["name"]) for r in repair.map_unique(rows, words, ["code"], "name").collect() if r["name"]) == [("c1", "Tg"), ("c1", "own")]
    samples = spark.createDataFrame([("d", "a", "e1", None), ("d", "b", "e2", None), ("d", "c", None, None)], "document_id string, sample_id string, entity_id string, type string")
    steps = spark.createDataFrame([("d", "1", "blending", ["a", "b"], ["c"])], "document_id string, step_id string, kind string, inputs array<string>, outputs array<string>")
    assert {r["sample_id"]: r["type"] for r in repair.infer_blends(samples, steps, ["blending"]).collect()} == {"a": None, "b": None, "c": "blend"}
