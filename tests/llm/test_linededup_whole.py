"""Line dedup as the query and the pipeline run it, against its definition."""

from __future__ import annotations

import re
from collections import defaultdict

from strataquery.llm.linededup import DEPTH, EXACT_DOCS, LEAST_SIMILAR, drop_recurring_lines
from strataquery.llm.queries import QUERIES
from tests.llm.conftest import texts_of
from tests.llm.test_linededup import lettered, number, rows, templates

SPACE = "[\t\x0b\f\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def spaced(line):
    return re.sub(SPACE, " ", line).strip(" ")


def mask(line):
    return re.sub("[0-9]+", "<*>", spaced(line)) if lettered(spaced(line)) else spaced(line)


def follows(m, n, constant):
    """Enough fields after the path are constants, a word among them."""
    same = [t for i, t in constant.items() if i >= DEPTH and m.split(" ")[i] == t]
    return len(same) >= (n - DEPTH) * LEAST_SIMILAR and any(map(lettered, same))


def brute(docs, min_docs=3, exact_docs=EXACT_DOCS):
    holders, exact, leaves = defaultdict(set), defaultdict(set), defaultdict(list)
    for k, t in docs:
        for line in (t or "").split("\n"):
            if spaced(line):
                holders[mask(line)].add(number(k, t or ""))
                exact[spaced(line)].add(number(k, t or ""))
    for m in holders:
        leaves[(m.count(" ") + 1, tuple(m.split(" ")[:DEPTH]))].append(m)
    template = {m: m for m in holders}
    for leaf, ms in leaves.items():
        if len(ms) < 2:
            continue
        template |= templates(leaf, ms, lambda m, constant, n=leaf[0]: follows(m, n, constant))
    docs_of = defaultdict(set)
    for m, t in template.items():
        docs_of[t] |= holders[m]
    out = []
    for k, t in docs:
        doc, kept = number(k, t or ""), []
        for line in t.split("\n") if t is not None else ():
            who, same = docs_of.get(template.get(mask(line)), set()), exact.get(spaced(line), set())
            if not (len(who) >= min_docs and doc > min(who) or len(same) >= exact_docs and doc > min(same)):
                kept.append(line)
        n = 0 if t is None else t.count("\n") + 1
        out.append((k, None if t is None else "\n".join(kept), n, n - len(kept)))
    return sorted(out, key=repr)


def dropped(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = rows(drop_recurring_lines(df, exact_docs=EXACT_DOCS))
    assert got == brute(docs)
    return {r[0]: r[3] for r in got}


def test_odd_and_real_documents(spark, odd, small):
    for df in (odd, small):
        assert rows(drop_recurring_lines(df, exact_docs=EXACT_DOCS)) == brute(texts_of(df))


def test_lines_of_two_documents(spark):
    words = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    docs = [(1, f"{words}\nfirst rest of its own"), (2, f"second text that stands here\n{words}"), (3, "of 12 parts number 5\nthird"), (4, "of 12 parts number 6\nfourth"), (5, "of 12 parts number 5\nfifth")]
    # the masked line stands in three documents, each of which has a template's copy
    assert dropped(spark, docs) == {1: 0, 2: 1, 3: 0, 4: 1, 5: 1}
    assert dropped(spark, docs[:4]) == {1: 0, 2: 1, 3: 0, 4: 0}


def test_short_unspaced_and_tabbed_lines(spark):
    docs = [(i, f"Home\n\n版权所有不得转载本站内容\nname\tof\tthe\tsite\nown{chr(97 + i)}") for i in range(4)]
    assert dropped(spark, docs) == {0: 0, 1: 3, 2: 3, 3: 3}


def test_lines_that_share_only_leading_tokens(spark):
    ends = ("eaesing", "for", "eron", "haan", "lytion")
    docs = [(i, f"Thor the haan {x}.\nWas erlytion that {x} {x}l\n{i} {i}2 {i}3\n- {i} -") for i, x in enumerate(ends)]
    assert dropped(spark, docs) == dict.fromkeys(range(5), 0)
    # one template still, where fields after the path agree
    docs = [(i, f"Served by node {x} at port {i}80 for all of you") for i, x in enumerate(ends)]
    assert dropped(spark, docs) == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1}


def test_query_is_whole(spark):
    sf = "/root/testdata/sf0.001"
    want = {r[0]: r[3] for r in brute(texts_of(spark.read.parquet(f"{sf}/documents.parquet")))}
    assert {r["doc_id"]: r["n_dropped"] for r in QUERIES["op9_line_dedup"](spark, sf).collect()} == want
