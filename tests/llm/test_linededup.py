from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest
import xxhash

from strataquery.llm.linededup import DEPTH, LEAST_SIMILAR, drop_recurring_lines
from tests.llm.conftest import texts_of



def number(k, t):
    """The id; for a null one a number past all ids that its text decides."""
    return k if k is not None else (1 << 62) + (xxhash.xxh64(t.encode(), seed=42).intdigest() & ((1 << 62) - 1))


def lettered(s):
    return any(c.isalpha() for c in s)


def templates(leaf, ms, follows):
    """The template of each line of a leaf that follows one: the leaf's, or that of the node one level down."""

    def constants(ms):
        out = {}
        for i in range(leaf[0]):
            c, tok = max((c, tok) for tok, c in Counter(m.split(" ")[i] for m in ms).items())
            if c * 2 > len(ms):
                out[i] = tok
        return out

    all_of = constants(ms)
    found = {m: leaf for m in ms if follows(m, all_of)}
    rest = [m for m in ms if m not in found]
    counts = Counter((i, t) for m in rest for i, t in enumerate(m.split(" ")) if i >= DEPTH and lettered(t) and all_of.get(i) != t)
    nodes = defaultdict(list)
    for m in rest:
        best = max(((counts[i, t], -i, t) for i, t in enumerate(m.split(" ")) if counts[i, t] > 1), default=None)
        if best:
            nodes[best[1:]].append(m)
    for node, some in nodes.items():
        if len(some) > 1:
            constant = constants(some)
            found |= {m: (leaf, node) for m in some if follows(m, constant)}
    return found


def brute(docs, min_docs=3, min_tokens=3):
    """(doc_id, text, n_lines, n_dropped) by the tree's definition."""
    mask = lambda line: re.sub("[0-9]+", "<*>", line.strip(" "))
    holders = defaultdict(set)
    for k, t in docs:
        for line in t.split("\n") if t is not None else ():
            m = mask(line)
            if len(m.split(" ")) >= min_tokens:
                holders[m].add(number(k, t))
    leaves = defaultdict(list)
    for m in holders:
        leaves[(m.count(" ") + 1, tuple(m.split(" ")[:DEPTH]))].append(m)
    template = {m: m for m in holders}
    for leaf, ms in leaves.items():
        if len(ms) < 2 or sum(len(holders[m]) for m in ms) < min_docs:
            continue
        template |= templates(leaf, ms, lambda m, constant: sum(m.split(" ")[i] == t for i, t in constant.items()) >= leaf[0] * LEAST_SIMILAR)
    docs_of = defaultdict(set)
    for m, t in template.items():
        docs_of[t] |= holders[m]
    out = []
    for k, t in docs:
        if t is None:
            out.append((k, None, 0, 0))
            continue
        doc, kept = number(k, t), []
        for line in t.split("\n"):
            who = docs_of.get(template.get(mask(line)), set())
            if not (len(who) >= min_docs and doc > min(who)):
                kept.append(line)
        out.append((k, "\n".join(kept), t.count("\n") + 1, t.count("\n") + 1 - len(kept)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("min_docs", [2, 3])
def test_odd_documents(spark, odd, min_docs):
    got = drop_recurring_lines(odd, min_docs)
    assert set(odd.columns) < set(got.columns)
    assert rows(got) == brute(texts_of(odd), min_docs)


def test_real_documents(spark, small):
    got = rows(drop_recurring_lines(small))
    assert got == brute(texts_of(small))
    assert sum(r[3] for r in got) > 0


def test_two_templates_of_one_leaf(spark):
    """Half of a leaf's lines follow one template, half another: each is one."""
    docs = [(i, f"alone {chr(97 + i) * 4}\n" + (f"the old log says user u{chr(97 + i)} has come in" if i % 2 else f"the old log says disk d{chr(97 + i)} was lost again")) for i in range(8)]
    got = drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string"), exact_docs=2)
    assert {r["doc_id"]: r["n_dropped"] for r in got.collect()} == {0: 0, 1: 0} | {i: 1 for i in range(2, 8)}


def test_many_recurring_lines_in_one_document(spark):
    text = "\n".join(f"line {i} of the list of many {chr(97 + i % 26)}x{i}y" for i in range(100_000))
    df = spark.createDataFrame([(1, text), (2, text), (3, "short")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in drop_recurring_lines(df, exact_docs=2).select("doc_id", "n_lines", "n_dropped").collect()}
    assert got[2] == (100_000, 100_000) and got[1][1] == 0 and got[3] == (1, 0)


def test_rows_without_id_are_documents_by_text(spark):
    df = spark.createDataFrame([(None, "a b c d e\nalone one"), (None, "a b c d e\nalone two"), (None, "a b c d e\nalone two"), (7, "a b c d e")], "doc_id long, text string")
    assert rows(drop_recurring_lines(df, exact_docs=2)) == sorted([(7, "a b c d e", 1, 0), (None, "alone one", 2, 1), (None, "alone two", 2, 1), (None, "alone two", 2, 1)], key=repr)


def test_variable_fields_are_one_template(spark):
    docs = [(i, f"{chr(97 + i) * 3} {chr(98 + i) * 4} {chr(99 + i) * 9} stands here alone\nServed by node {chr(98 + i) * 4} at port {i}80 for all of you") for i in range(8)]
    got = drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_dropped"] for r in got.collect()} == {0: 0} | dict.fromkeys(range(1, 8), 1)


def test_empty_table(spark, empty):
    assert drop_recurring_lines(empty).count() == 0
