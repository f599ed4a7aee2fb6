"""Queries with SQL: both sides give the same rows."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_queries import connect, rows_of  # noqa: E402

from meterline.llm.queries import CHECK_SQL, QUERIES  # noqa: E402


def same(df, db: duckdb.DuckDBPyConnection, sql: str) -> None:
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(names) == sorted(df.columns)
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("name", list(CHECK_SQL))
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, name, scale):
    folder = f"/root/testdata/{scale}"
    same(QUERIES[name](spark, folder), connect(folder), CHECK_SQL[name])
