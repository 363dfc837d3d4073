"""Every query with SQL gives what DuckDB gives over the smallest tables."""

import glob
import os

import duckdb
import pytest

from siftloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as from '{path}'")
    return con


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(round(r[i], 6)) if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, SF)
    want = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), names)
