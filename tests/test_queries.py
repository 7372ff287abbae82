"""Every registered query with SQL against DuckDB, on the smaller folders."""

import math
from pathlib import Path

import duckdb
import pytest

from rasterloom import plans

FOLDER = "/root/testdata/sf0.001"
SQL = plans.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        c.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    cell = lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted(names), sorted(([cell(r[k]) for k in order] for r in data), key=str)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, duck, name):
    df = plans.queries()[name](spark, FOLDER)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(SQL[name])
    want = rows([c[0] for c in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    for a, b in zip(got[1], want[1]):
        assert all(x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=2e-6)) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", [n for n in plans.queries() if n not in SQL])
def test_query_without_sql_runs(spark, name):
    assert plans.queries()[name](spark, FOLDER).count() > 0
