"""Each registered query with SQL gives DuckDB's rows; the others run."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import strataquery.plans.checks
import strataquery.plans.families
import strataquery.plans.intake
import strataquery.plans.policies
import strataquery.plans.queries
import strataquery.plans.texts
from strataquery.plans.register import ORACLE_SQL, QUERIES

SF = Path("/root/testdata/sf0.001")


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    return str(pd.Timestamp(value)) if hasattr(value, "isoformat") else value


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, str(SF))
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    ran = con.execute(ORACLE_SQL[name])
    order = [d[0] for d in ran.description]
    assert sorted(order) == names
    want = sorted((tuple(plain(r[order.index(c)]) for c in names) for r in ran.fetchall()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, str(SF)).count() >= 0
