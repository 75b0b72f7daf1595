"""Every registered query against its SQL on DuckDB, over whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from docfold.plans.queries import ORACLES, QUERIES, TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value if value is None or isinstance(value, (int, bool)) else str(value)


def as_rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert as_rows(df.columns, df.collect()) == as_rows(names, cursor.fetchall())


def test_entry_is_the_flagship(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["check_name", "check_type", "table_name", "measure", "expected", "status"]
    assert df.count() == 13
