"""Every query of the core registry against its SQL over the same tables."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from burstline.plans.oracles import ORACLES
from burstline.plans.table_queries import registered

QUERIES = registered()
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
TYPES = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def ordered(rows, columns, names):
    places = [columns.index(name) for name in names]
    picked = [tuple(row[i] for i in places) for row in rows]
    return sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, tables, name):
    assert_matches(QUERIES[name](spark, tables), duck.sql(ORACLES[name]))


def assert_matches(actual, relation):
    names = sorted(actual.columns)
    assert names == sorted(relation.columns)
    sql_types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    assert {c: TYPES[t] for c, t in actual.dtypes} == sql_types
    expected = relation.fetchall()
    assert expected
    rows = actual.collect()
    assert ordered(rows, actual.columns, names) == ordered(expected, relation.columns, names)


def test_the_core_queries_are_in_the_entry():
    assert QUERIES.keys() <= spark_entry.queries().keys()
    assert ORACLES.items() <= spark_entry.oracle_sql().items()


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.count() > 0
    assert result.columns[:3] == ["window_start", "window_end", "User_ID"]
