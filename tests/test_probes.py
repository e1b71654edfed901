"""Cases that earlier forms got wrong, and defined cases of new operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataquery.functions import payload, predicates, text
from strataquery.operators import context, evidence, graph, grid, recovery, refs, repair, salvage, validate


def one(spark, column):
    return spark.range(1).select(column).collect()[0][0]


def test_ids_keep_all_digits(spark):
    rows = spark.range(1500).select(F.lit("d").alias("document_id"), F.col("id"))
    assert repair.renumber(rows, "id", "p").select("new_id").distinct().count() == 1500
    assert refs.first_seen_ids(spark.range(300), F.col("id"), "id", "ev", 2).select("ref_id").distinct().count() == 300


def test_numbers_go_on_after_the_highest(spark):
    rows = spark.createDataFrame([("d", 1), ("d", 2), ("e", 1)], "document_id string, id int")
    had = spark.createDataFrame([("d", "p009"), ("d", "p1000"), ("d", "q5000"), ("e", None)], "document_id string, k string")
    assert sorted(r["new_id"] for r in repair.number_after(rows, had, "k", "id", "p").collect()) == ["p001", "p1001", "p1002"]


def test_cascade_in_any_order_and_nulls(spark):
    tables = {"a": spark.createDataFrame([(1,), (2,)], "id int"), "b": spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, a int"), "c": spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, b int")}
    kept = refs.cascade(tables, [("c", "b", "b", "id"), ("b", "a", "a", "id")], {"a": spark.createDataFrame([(2,)], "key int")})
    assert {n: sorted(r["id"] for r in df.collect()) for n, df in kept.items()} == {"a": [1], "b": [1, 3], "c": [1, 3]}


def test_recovery_of_short_sentences(spark):
    """The last word may end inside a longer one, whatever the sentence's length."""
    words = "alpha beta gamma delta epsilon zeta eta".split()
    asked = spark.createDataFrame([(n, " ".join(words[:n])) for n in range(1, 8)], "sentence_id int, sentence string")
    blocks = spark.createDataFrame([(1, "x " + " ".join(words) + "s y"), (2, "nothing of it")], "block_id int, text string")
    assert {r["sentence_id"]: (r["matches"], r["block_id"]) for r in evidence.recover_block(asked, blocks).collect()} == {n: (1, 1) for n in range(1, 8)}


def test_sentences_without_latin_words_match(spark):
    asked = spark.createDataFrame([(1, "玻璃化转变温度"), (2, "The Tg of it"), (3, "!?")], "sentence_id int, sentence string")
    blocks = spark.createDataFrame([(1, "聚合物的玻璃化转变温度是"), (2, "and the tg of it was"), (3, None), (4, "the and and and")], "block_id int, text string")
    assert {(r["sentence_id"], r["block_id"], r["status"]) for r in evidence.match_all(asked, blocks).collect()} == {(1, 1, "strict"), (2, 2, "normalised")}


@pytest.mark.parametrize(("body", "cells"), [
    ('<table><tr><td rowspan="²">a</td><td rowspan="1000000000" colspan=2>b</td></tr><tr><td>c</td><td>d</td></tr></table>', {(0, 0, "a"), (0, 1, "b"), (1, 0, "c"), (1, 3, "d")}),
    ("a | b\n--- | :---:\n- | -", {(0, 0, "a"), (0, 1, "b"), (1, 0, "-"), (1, 1, "-")}),
    ("<table></table>| a | b |", {(0, 0, "<table></table>"), (0, 1, "a"), (0, 2, "b")}),
    ("", set()),
])
def test_table_bodies(body, cells):
    assert {(c[0], c[1], c[4]) for c in grid.cells_of(body)} == cells


@pytest.mark.parametrize(("value", "yes"), [("12 mL", True), ("5 kV", False), ("3 sec", True), (r"0.0032 \pm 6 \times 10^{-6}", True), ("T_d10", False), ("1 : 2 of 3", False), ("Tg", False)])
def test_value_like(spark, value, yes):
    assert one(spark, text.is_value_like(F.lit(value))) is yes


def test_first_node_wins(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, l string")
    b = spark.createDataFrame([("2", "z"), ("3", None)], "k string, l string")
    assert {tuple(r) for r in graph.first_nodes([("a", a, "k", "l"), ("b", b, "k", "l")]).collect()} == {("1", "a", "x"), ("2", "a", "y"), ("3", "b", None)}


def test_salvage_rules_and_rounds(spark):
    """A chain of rejections through every rule, a cycle of references, and codes of each object."""
    objects = spark.createDataFrame([(x, x[0]) for x in ("a1", "a2", "b1", "b2", "s1", "s2", "p1", "p2", "p3", "c1", "c2")], "object_id string, object_type string")
    links = spark.createDataFrame([
        ("b1", "of", "a1", "required"), ("b2", "of", "a2", "required"), ("s1", "of", "b1", "required"), ("s2", "of", "b2", "required"), ("p1", "series", "s1", "parent"), ("p2", "series", "s2", "parent"), ("p3", "series", "s2", "parent"),
        ("c1", "series", "s1", "any"), ("c1", "series", "s2", "any"), ("c2", "series", "s1", "any"), ("a2", "x", "gone", "optional"), ("a2", "x", "b1", "optional"), ("a2", "x", None, "required"), ("b2", "twin", "c1", "optional"),
    ], "object_id string, field string, ref_id string, rule string")
    errors = spark.createDataFrame([("a1", "bad", "m"), ("a1", "bad", "again"), ("p2", "worse", "m"), (None, "document", "m"), ("zz", "unknown", "m")], "object_id string, code string, message string")
    got = salvage.salvage(objects, links, errors)
    assert sorted(r["object_id"] for r in got["published"].collect()) == ["a2", "b2", "c1", "p3", "s2"]
    codes = {r["object_id"]: r["codes"] for r in got["rejected"].collect()}
    assert codes == {"a1": ["bad"], "b1": ["missing_required_reference"], "s1": ["missing_required_reference"], "p1": ["parent_rejected"], "c2": ["missing_required_reference"], "p2": ["worse"]}
    assert {(r["object_id"], r["ref_id"]) for r in got["pruned"].collect()} == {("a2", "gone"), ("a2", "b1"), ("c1", "s1")}
    assert sorted(r["code"] for r in got["document_errors"].collect()) == ["document", "unknown"]
    assert all(r["conserved"] for r in salvage.publication_summary(objects, got).collect())


def test_series_falls_without_points(spark):
    objects = spark.createDataFrame([("s1", "s"), ("p1", "p"), ("s9", "s")], "object_id string, object_type string")
    links = spark.createDataFrame([("p1", "series", "s1", "parent")], "object_id string, field string, ref_id string, rule string")
    errors = spark.createDataFrame([("p1", "bad", "m")], "object_id string, code string, message string")
    got = salvage.salvage(objects, links, errors)
    assert [r["object_id"] for r in got["published"].collect()] == ["s9"]
    assert salvage.salvage(objects.limit(0), links.limit(0), errors.limit(0))["published"].count() == 0


def test_cycles_of_parents_and_steps(spark):
    parents = spark.createDataFrame([("d", 1, 2), ("d", 2, 3), ("d", 3, 2), ("d", 4, None), ("e", 1, 1), ("e", 2, 7)], "document_id string, id int, parent int")
    assert sorted((r["code"], r["object_id"]) for r in validate.check_parents(parents, "id", "parent").collect()) == [("parent_cycle", "1"), ("parent_cycle", "2"), ("parent_cycle", "3"), ("self_parent", "1"), ("unknown_parent", "2")]
    samples = spark.createDataFrame([("d", s, "e") for s in "abc"], "document_id string, sample_id string, entity_id string")
    steps = spark.createDataFrame([("d", 1, ["a"], ["b"]), ("d", 2, ["b"], ["a"]), ("d", 3, ["c", "x"], ["c"])], "document_id string, step_id int, inputs array<string>, outputs array<string>")
    assert sorted((r["code"], r["object_id"]) for r in validate.check_steps(samples, steps).collect()) == [("in_and_out", "3"), ("step_cycle", "a"), ("step_cycle", "b"), ("unknown_sample", "3")]


def test_evidence_ladder_of_a_document(spark):
    blocks = spark.createDataFrame([("d", "b1", 1, "text", "Tg was 350 K here"), ("d", "b2", 2, "text", "the melt was 412 K"), ("e", "b1", 1, "text", "Tg was 350 K")], "document_id string, block_id string, page int, type string, text string")
    found = spark.createDataFrame([("d", "1", "b1", 1, "text", "Tg was 350 K"), ("d", "2", "b1", 2, "table", "the melt was 412 K"), ("d", "3", "b9", 1, "text", "x"), ("d", "4", "b2", 2, "text", "not there at all")], "document_id string, object_id string, block_id string, page int, source_type string, sentence string")
    got = {(r["object_id"], r["code"], r["severity"]) for r in validate.check_evidence(found, blocks).collect()}
    assert got == {("2", "page_mismatch", "error"), ("2", "type_mismatch", "error"), ("2", "found_elsewhere", "warning"), ("3", "unknown_block", "error"), ("4", "evidence_not_in_source", "error")}


def test_row_labels_fill_up(spark):
    cells = spark.createDataFrame([("t", 0, 1, 0, "2a"), ("t", 0, 1, 1, "0-2-0-9"), ("t", 1, 1, 0, "b"), ("t", 1, 1, 1, " "), ("t", 1, 1, 2, "9")], "table_id string, row_index int, row_span int, column_index int, text string")
    asked = spark.createDataFrame([("x", "t", 1, 2)], "target_id string, table_id string, row_index int, column_index int")
    assert {(r["column_index"], r["label"], r["basis"]) for r in recovery.row_labels(cells, asked).collect()} == {(0, "b", "row_cell_direct"), (1, "0-2-0-9", "row_cell_filled_up")}


def test_json_ladder(spark):
    cases = {'{"a": 1}': "plain", 'x\n```json\n{"a": 1}\n```': "fenced", 'so {"a": {"b": 2}} it is': "braced", r'{"a": "5 \pm 1"}': "mended", '{"a": [1': "truncated", "nothing": "none", "[1]": "none"}
    got = spark.createDataFrame([*cases.items()], "t string, want string").select("want", payload.json_object(F.col("t"))["how"].alias("how")).collect()
    assert all(r["want"] == r["how"] for r in got), got


def test_paths(spark):
    cases = {"a/b": True, "../a": False, "a/../../b": False, "/a": False, "C:\\x": False, "a/./../b": True, "": True}
    got = {r["p"]: r["ok"] for r in spark.createDataFrame([(p,) for p in cases], "p string").select("p", predicates.stays_inside(F.col("p")).alias("ok")).collect()}
    assert got == cases


def test_supersets_need_one_largest(spark):
    sets = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"]), (3, ["a", "b", "c"]), (4, ["a", "b", "d"]), (5, ["z"])], "k int, v array<string>")
    assert {tuple(r) for r in context.supersets(sets, "k", "v").collect()} == set()
    assert {tuple(r) for r in context.supersets(sets.where("k <> 4"), "k", "v").collect()} == {(1, 3), (2, 3)}
