"""The registered queries of this folder on the smallest tables; those with SQL next to it."""

from pathlib import Path

import duckdb
import pytest

from tasteforge.llm.queries import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for path in SF.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, str(SF))
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(result.fetchall())


def test_there_is_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
