"""Every general query with SQL gives the rows that DuckDB gives; the others run and keep their schema."""

import math
from pathlib import Path

import duckdb
import pytest

from quillspark.queries import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
ALL_NULL: dict[str, set[str]] = {"pipeline_chunks": {"chunk_part"}}
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, (int, bool, str)) else str(v)


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, type(x).__name__, x) for x in r))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = [tuple(_value(r[names.index(c)]) for c in columns) for r in result.fetchall()]
    assert _sorted([tuple(_value(r[c]) for c in columns) for r in df.collect()]) == _sorted(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    """A query without SQL gives rows, the same on a second run, and none of its columns is null throughout."""
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert rows and {c for c in df.columns if all(r[c] is None for r in rows)} <= ALL_NULL.get(name, set())
    assert sorted(map(str, rows)) == sorted(map(str, QUERIES[name](spark, FOLDER).collect()))
