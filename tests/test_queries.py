"""Every registered query against its SQL in another engine."""

import math

import duckdb
import pytest
from conftest import plan

import __spark_entry__ as entry
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 2


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    # The one product is the grid itself: the models with a catalog of checked size.
    executed = plan(df)
    assert "CartesianProduct" not in executed
    assert executed.count("NestedLoopJoin") == executed.count("NestedLoopJoin BuildRight, Cross")
    columns = sorted(df.columns)
    found = sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=repr)
    answer = duck.sql(entry.oracle_sql()[name])
    order = [answer.columns.index(c) for c in columns]
    assert len(order) == len(answer.columns)
    expected = sorted((tuple(value(r[i]) for i in order) for r in answer.fetchall()), key=repr)
    assert found == expected and found
