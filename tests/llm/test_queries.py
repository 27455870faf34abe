"""Registered training-data queries against their SQL, and which have none."""

import duckdb
import pytest

from burstline.llm.queries import ORACLES, QUERIES
from tests.test_oracles import TABLES, assert_matches

# No SQL: tested against plain versions, round trips or held-out labels in these modules.
PLAIN_VERSIONS = {
    "op1_packing": "test_packing",
    "op2_sentencepiece": "test_sentencepiece",
    "op4_pii": "test_pii",
    "op9_suffixes": "test_suffixes",
    "op10_quality": "test_quality",
    "op11_whitening": "test_whitening",
    "op12_token_files": "test_token_files",
    "op13_periods": "test_periods",
    "pack_conversations": "test_packing",
}


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet'")
    return connection


def test_every_query_has_sql_or_a_plain_version():
    assert set(QUERIES) == set(ORACLES) | set(PLAIN_VERSIONS)
    assert not set(ORACLES) & set(PLAIN_VERSIONS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, tables, name):
    assert_matches(QUERIES[name](spark, tables), duck.sql(ORACLES[name]))
