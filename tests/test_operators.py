"""Operators on small literal inputs, with the cases that their rules name."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from strataquery.functions import numeric, text
from strataquery.operators import align, evidence, graph, grid, ordered, refs, runlog
from strataquery.sources import documents as sources


def one(df):
    return df.collect()[0][0]


def test_ratio_of_nothing_has_four_rules(spark):
    row = spark.range(1).select(*[numeric.ratio(F.lit(0), F.lit(0), r).alias(r) for r in numeric.RATIO_RULES]).collect()[0]
    assert row.asDict() == {"audit": None, "rate": 0.0, "complete": 1.0, "safe": None}


def test_completeness_example(spark):
    rows = spark.createDataFrame([("d", True, True, True, True), ("d", False, False, False, False)], "doc string, sample boolean, evidence boolean, unit boolean, cond boolean")
    got = refs.binding_rates(rows, ["doc"], {c: F.col(c) for c in ("sample", "evidence", "unit", "cond")}).collect()[0]
    assert (got["total"], got["sample"], got["cond_rate"]) == (2, 1, 0.5)


def test_alignment_measures(spark):
    rows = spark.createDataFrame([("matched",)] * 8 + [("value_diff",)] * 2 + [("truth_only",)] * 2, "status string")
    got = align.measures(rows).collect()[0]
    assert (got["precision"], got["recall"], got["f1"]) == (0.8, 0.6667, 0.7273)


def test_greedy_alignment_prefers_a_value_that_fits(spark):
    schema = "group_id long, id long, name string, low double, high double, unit string"
    truth = spark.createDataFrame([(1, 1, "tg", 350.0, 350.0, "K"), (1, 2, "tg", 400.0, 400.0, "K"), (1, 3, "mn", 5.0, 5.0, None), (2, 9, "tg", 1.0, 1.0, "K")], schema)
    found = spark.createDataFrame([(1, 10, "tg", 401.0, 401.0, "K"), (1, 11, "tg", 500.0, 500.0, "K"), (1, 12, "eta", 1.0, 1.0, None)], schema)
    got = {(r["truth_id"], r["found_id"], r["status"]) for r in align.align(truth, found).collect()}
    # the first truth row takes the first of its name when none fits
    assert got == {(1, 10, "value_diff"), (2, 11, "value_diff"), (3, None, "truth_only"), (9, None, "truth_only"), (None, 12, "found_only")}


def test_grid_spans_skip_taken_slots(spark):
    body = "<table><tr><th rowspan=2>S</th><th colspan=2>T</th></tr><tr><th>Tg</th><th>[Q]</th></tr><tr><td>A</td><td>1</td><td>8.60</td></tr></table>"
    cells = grid.table_cells(spark.createDataFrame([("b", body)], "block_id string, table_body string"))
    assert {r["text"]: r["cell_id"] for r in cells.collect()}["8.60"] == "b:r0002:c0002"
    context = grid.header_context(cells).where("text = '8.60'").collect()[0]
    assert (context["column_headers"], context["row_headers"]) == (["T", "[Q]"], ["A"])


def test_grid_markdown_drops_the_separator(spark):
    cells = grid.table_cells(spark.createDataFrame([("b", "| a | b |\n|---|---|\n| 1 | 2 |"), ("n", None)], "block_id string, table_body string"))
    assert sorted(r["cell_id"] for r in cells.collect()) == ["b:r0000:c0000", "b:r0000:c0001", "b:r0001:c0000", "b:r0001:c0001"]


def test_locators(spark):
    cells = grid.table_cells(spark.createDataFrame([("b", "| s | tg | tm |\n|---|---|---|\n| A | 5 | 7 |\n| B | 5 | 9 |")], "block_id string, table_body string"))
    asked = spark.createDataFrame([(1, "b", "B", "tg", "5"), (2, "b", "", "", "5"), (3, "b", "A", "tm", "8")], "locator_id int, block_id string, row_label string, column_label string, cell_value string")
    assert {(r["locator_id"], r["cell_id"], r["status"]) for r in grid.resolve_locator(cells, asked).collect()} == {(1, "b:r0002:c0001", "matched"), (2, None, "ambiguous"), (3, None, "unresolved")}


@pytest.mark.parametrize(("value", "yes"), [("8.6", True), ("5 wt", True), ("1:2", False), ("PE-1", False), ("see 5 below", False), ("", False)])
def test_value_like(spark, value, yes):
    assert one(spark.range(1).select(text.is_value_like(F.lit(value)))) is yes


@pytest.mark.parametrize(("sentence", "source", "status"), [("Tg of 0.063", "a Tg of 0.063 b", "strict"), ("Tg of 0 . 063", "A TG OF 0.063", "normalised"), ("q w e r t y u i o p", "q w e r t y u i o x p z", "near"), ("one two", "three", "unresolved")])
def test_match_ladder(spark, sentence, source, status):
    assert one(spark.range(1).select(evidence.match_ladder(F.lit(sentence), F.lit(source)))) == status


def test_recovery_needs_one_block(spark):
    asked = spark.createDataFrame([(1, "aa bb cc dd ee ff gg hh"), (2, "short one"), (3, "not there at all in any of them")], "sentence_id int, sentence string")
    blocks = spark.createDataFrame([(1, "x aa bb cc dd ee ff gg hh y"), (2, "short one"), (3, "a short one"), (4, None)], "block_id int, text string")
    assert {(r[0], r["matches"], r["block_id"], r["status"]) for r in evidence.recover_block(asked, blocks).collect()} == {(1, 1, 1, "recovered"), (2, 2, None, "ambiguous"), (3, 0, None, "unresolved")}


def test_cascade_conserves(spark):
    tables = {"a": spark.createDataFrame([(1,), (2,)], "id int"), "b": spark.createDataFrame([(1, 1), (2, 2), (3, 2)], "id int, a int"), "c": spark.createDataFrame([(1, 3), (2, 1)], "id int, b int")}
    kept = refs.cascade(tables, [("b", "a", "a", "id"), ("c", "b", "b", "id")], {"a": spark.createDataFrame([(2,)], "key int")})
    assert {r["object_type"]: (r["input"], r["published"], r["rejected"]) for r in refs.conservation(tables, kept).collect()} == {"a": (2, 1, 1), "b": (3, 1, 2), "c": (2, 1, 1)}


def test_first_seen_ids_are_gapless(spark):
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 37).alias("k"))
    got = refs.first_seen_ids(rows, F.col("k"), "id", "ev", 3).orderBy("first").collect()
    assert [r["ref_id"] for r in got] == [f"ev{i:03d}" for i in range(1, 38)]


def test_cycles_and_inheritance(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 2), (4, 5), (0, 1)], "a int, b int")
    assert {r["node"] for r in graph.cyclic_nodes(links).collect()} == {0, 1, 2, 3}
    values = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, "y"), (5, None)], "node int, value string")
    steps = spark.createDataFrame([(1, 2), (2, 3), (4, 5), (1, 5)], "a int, b int")
    assert {r["node"]: r["value"] for r in graph.inherit(values, steps).collect()} == {1: "x", 2: "x", 3: "x", 4: "y", 5: None}


def test_chunks(spark):
    rows = spark.createDataFrame([("d", i, n) for i, n in enumerate([100, 700, 5000, 10])], "g string, i int, n int")
    assert [r["chunk"] for r in ordered.chunk_by_budget(rows, "g", "i", "n", 1000).orderBy("i").collect()] == [0, 1, 2, 3]


def test_attempts_and_acceptance(spark):
    log = spark.createDataFrame([(1, 1, "running", 5.0), (1, 2, "done", None), (2, 1, "running", 5.0), (3, 1, "running", 99.0)], "attempt_id int, at int, status string, lease_until double")
    assert {r["attempt_id"]: r["status"] for r in runlog.attempt_states(log, F.lit(10.0)).collect()} == {1: "done", 2: "interrupted_uncertain", 3: "running"}
    assert runlog.acceptance(log, "done").collect()[0]["accepted"] is False


def test_json_documents_route_rejects(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"id": "a", "n": 1}))
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text(json.dumps({"n": 2}))
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])
    rows, rejects = sources.read_json_documents(spark, f"file://{tmp_path}", schema, ("id",))
    assert [r["id"] for r in rows.collect()] == ["a"]
    assert sorted((r["source_file"][-6:], r["reason"]) for r in rejects.collect()) == [("b.json", "invalid_json"), ("c.json", "schema")]


def test_manifest_differences(spark):
    a = spark.createDataFrame([("x", 1, "h"), ("y", 2, "h"), ("z", 3, "h")], "name string, size_bytes long, sha256 string")
    b = spark.createDataFrame([("x", 1, "h"), ("y", 5, "h"), ("w", 1, "h")], "name string, size_bytes long, sha256 string")
    assert {(r["name"], r["problem"]) for r in sources.manifest_differences(a, b).collect()} == {("y", "size"), ("z", "missing"), ("w", "unlisted")}
