"""Every registered query against its SQL, at the smallest scale."""

import os

import __spark_entry__ as entry_points
import duckdb
import pytest

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(
    not os.path.isdir(entry_points.SMALL), reason="the given tables are not here"
)


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{entry_points.SMALL}/{name}.parquet'"
        )
    return connection


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def test_names_agree():
    """Every query of the library itself has its SQL; text operators may go without."""
    assert {query.__name__ for query in entry_points.QUERIES} == set(entry_points.SQL)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(entry_points.SQL))
def test_query(spark, database, name):
    found = entry_points.queries()[name](spark, entry_points.SMALL)
    wanted = database.execute(entry_points.SQL[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(found.columns) == sorted(columns)
    assert comparable(found.columns, found.collect()) == comparable(columns, wanted.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_multistream_files_are_read_in_splits(spark):
    pieces = entry_points.staged(spark, entry_points.SMALL, "multistream").segments
    splits = pieces.select("file_path", "block_start").distinct().count()
    assert splits > pieces.select("file_path").distinct().count()
