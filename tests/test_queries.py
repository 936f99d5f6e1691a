"""Every named query against its SQL on the smallest driver tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
    benchmark labels conversations""".split()


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, sf, db, name):
    frame = entry.queries()[name](spark, sf)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert bag(frame.columns, [tuple(r) for r in frame.collect()]) == bag(columns, result.fetchall())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["part_id", "n_rows", "min_pos", "max_pos"] and frame.count() > 0
