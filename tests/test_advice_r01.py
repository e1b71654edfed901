"""Whole jobs, where a query or operator once did a part: each holds against a plain version over all rows."""

from __future__ import annotations

import re

from strataquery.operators import graph
from strataquery.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_cycles_of_all_suppliers(spark):
    links = {r["s_suppkey"]: (r["s_suppkey"] * 7 + 3) % 31 for r in spark.read.parquet(f"{SF}/supplier.parquet").collect()}

    def leads_to_cycle(node):
        seen = set()
        while node in links and node not in seen:
            seen.add(node)
            node = links[node]
        return node in seen

    want = {node for node in links if leads_to_cycle(node)}
    assert max(want) > 30
    assert {r["node"] for r in QUERIES["q29_cycle_check"](spark, SF).collect()} == want


def test_inheritance_along_long_chains(spark):
    # a chain of 30 steps, and a cycle that nothing enters
    values = spark.createDataFrame([(i, "x" if i == 0 else None) for i in range(31)] + [(40, None), (41, None)], "node int, value string")
    steps = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(40, 41), (41, 40)], "a int, b int")
    want = dict.fromkeys(range(31), "x") | {40: None, 41: None}
    assert {r["node"]: r["value"] for r in graph.inherit(values, steps).collect()} == want


def test_inheritance_of_all_parts(spark):
    parts = {r["p_partkey"]: r["p_brand"] if r["p_partkey"] % 16 == 1 else None for r in spark.read.parquet(f"{SF}/part.parquet").collect()}
    for node in sorted(parts):
        parts[node] = parts[node] or parts.get(node - 1)
    assert {r["node"]: r["value"] for r in QUERIES["q32_type_inheritance"](spark, SF).collect()} == parts


def test_keys_of_whole_texts(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = {k: None if t is None else re.sub("[^0-9a-z]+", "", t.lower()) for k, t in texts.items()}
    got = {r["doc_id"]: r["key"] for r in QUERIES["q16_text_normalise"](spark, SF).collect()}
    assert got == want
    assert max(len(k) for k in got.values() if k) > 400
