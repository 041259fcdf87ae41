"""Every registered query that has SQL gives what DuckDB gives, at the smallest scale."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as e

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def test_entry(spark):
    assert e.entry(spark).count() == 1


def cell(x):
    return None if x is None or isinstance(x, float) and math.isnan(x) else repr(float(x)) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(e.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = e.queries()[name](spark, str(SF))
    want = duck.execute(e.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    rows = Counter(tuple(cell(r[n]) for n in names) for r in got.collect())
    assert rows == Counter(tuple(map(cell, r)) for r in want.fetchall())
