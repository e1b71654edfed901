from __future__ import annotations

from datetime import date

import duckdb

from strataquery.llm.queries import ORACLE_SQL, QUERIES
from strataquery.llm.urlfilter import judge

ENTRIES = "kind string, pattern string, action string, category string, listed_on date"
CAPTURES = "page_id long, url string, fetched_on date, action string, pattern string, kind string"


def d(m, day=1):
    return date(2024, m, day)


LIST = [
    ("host", "bad.example", "block", "spam", d(2)), ("host", "bad.example", "remove", None, d(5)), ("host", "bad.example", "block", "spam", d(8)),
    ("prefix", "bad.example/ok/", "allow", "trusted", d(3)), ("host", "sub.bad.example", "allow", "x", d(4)), ("host", "tie.example", "allow", "a", d(1)), ("host", "tie.example", "block", "b", d(1)),
    ("host", None, "block", "n", d(1)), (None, "x", "block", "n", d(1)), ("host", "late.example", "block", "n", None), ("host", "odd.example", "unknown", "n", d(1)),
]
PAGES = [
    (1, "http://bad.example/x", d(1), False, None), (2, "http://bad.example/x", d(2), True, "bad.example"), (3, "https://www.BAD.example:80/x?q", d(4, 30), True, "bad.example"), (4, "http://bad.example/x", d(5), False, None),
    (5, "http://bad.example/x", d(9), True, "bad.example"), (6, "http://bad.example/ok/x", d(4), False, "bad.example/ok/"), (7, "http://a.sub.bad.example/", d(4), False, "sub.bad.example"), (8, "http://tie.example", d(3), True, "tie.example"),
    (9, None, d(3), False, None), (10, "http://bad.example/x", None, False, None), (11, "not a url", d(3), False, None), (12, "", d(3), False, None), (None, "http://bad.example/x", d(2), True, "bad.example"), (2, "http://bad.example/x", d(2), True, "bad.example"), (13, "http://odd.example/", d(3), False, None), (14, "http://localhost/x/", d(3), False, None),
    (15, "http://u:p@bad.example/x", d(2), True, "bad.example"), (16, "http://bad.example./x", d(2), True, "bad.example"), (17, " \thttp://bad.example/x", d(2), True, "bad.example"), (18, "http://bad.example@good.example/", d(2), False, None),
    (19, "http://u@x@bad.example:81", d(2), True, "bad.example"), (20, "http:///x", d(2), False, None), (21, "http://[::1]:80/x/", d(2), False, None),
]


def test_entries_hold_from_their_day_until_the_next(spark):
    captures = spark.createDataFrame([(p, u, f, "old", "old", "old") for p, u, f, _, _ in PAGES], CAPTURES)
    got = judge(captures, spark.createDataFrame(LIST, ENTRIES))
    assert sorted(((r["page_id"], r["url"], r["fetched_on"], r["blocked"], r["pattern"]) for r in got.collect()), key=repr) == sorted(PAGES, key=repr)
    assert {r["kind"] for r in got.collect()} == {"old"}


def test_empty_list_and_empty_table(spark):
    captures = spark.createDataFrame([(1, "http://bad.example/x", d(3), "", "", "")], CAPTURES)
    none = spark.createDataFrame([], ENTRIES)
    assert [r["blocked"] for r in judge(captures, none).collect()] == [False]
    assert judge(captures.limit(0), spark.createDataFrame(LIST, ENTRIES)).count() == 0


def test_query_gives_the_rows_of_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op3_url_filter"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    ran = con.execute(ORACLE_SQL["op3_url_filter"])
    names = [x[0] for x in ran.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(ran.fetchall(), key=repr)
