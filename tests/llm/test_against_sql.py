"""Every text query that SQL can state, at the smallest scale."""

import os

import duckdb
import pytest

from dumptables.llm import queries

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query(spark, name):
    database = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    found = queries.QUERIES[name](spark, SMALL)
    wanted = database.execute(queries.SQL[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert comparable(found.columns, found.collect()) == comparable(columns, wanted.fetchall())
