"""Every registered query against its SQL on the smallest tables, and what no plan may contain."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tasteforge.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
NO_SQL: set[str] = set()
IN_PYTHON = {"factor_topk", "recommend_topk"}

pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_the_entry_point_has_every_query():
    assert QUERIES.items() <= __spark_entry__.queries().items()
    assert ORACLES.items() <= __spark_entry__.oracle_sql().items()


def test_only_the_iterative_queries_lack_sql():
    assert QUERIES.keys() - ORACLES.keys() == NO_SQL and not ORACLES.keys() - QUERIES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, plan, name):
    df = QUERIES[name](spark, str(SF))
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in IN_PYTHON:
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
    got = by_name(df.columns, [tuple(r) for r in df.collect()])
    assert got[1]
    if name in ORACLES:
        result = db.execute(ORACLES[name])
        assert got == by_name([c[0] for c in result.description], result.fetchall())
