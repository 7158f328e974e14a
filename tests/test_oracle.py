"""Every registered query against its SQL twin."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, str(x)) for x in r))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


# Operators that pair every row with every other, or that hand rows to Python.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapInArrow")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    columns = sorted(df.columns)
    got = in_order(tuple(r[c] for c in columns) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = in_order(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert got == want
    assert got


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() == 5698
