"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(record[i] for i in order) for record in records), key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, DATA)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(row) for row in got.collect()]) == rows(columns, want.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
