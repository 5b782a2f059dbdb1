"""Every registered query against its SQL on an independent engine."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
QUERIES = registry.trip_queries()
ORACLE = registry.trip_oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _value(v):
    return None if v is None or (isinstance(v, float) and math.isnan(v)) else v


def _rows(frame, columns):
    """Rows with columns by name, sorted; values exactly as the engine gave them."""
    rows = [tuple(_value(v) for v in row) for row in frame]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_oracle(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    expected = _rows(cursor.fetchall(), columns)
    assert expected
    assert _rows(found.collect(), found.columns) == expected


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == {"landing_checksums"}


def test_entry(spark, monkeypatch):
    report = registry.entry(spark)
    assert report.columns == ["week", "PULocationID", "trip_count", "rank"]
    assert report.count() > 0
