"""Registered queries on unusual tables and sessions."""

import shutil

import pytest

from burstline.plans.table_queries import QUERIES, registered

SLOW_TWINS = {"stream_restart", "stream_late_drop", "stream_normal", "stream_decode"}


@pytest.fixture(scope="module")
def empty_events(spark, tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    spark.read.parquet(f"{tables}/events.parquet").limit(0).write.parquet(
        str(folder / "events.parquet")
    )
    for name in ("customer", "supplier"):
        shutil.copy(f"{tables}/{name}.parquet", folder)
    return str(folder)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW_TWINS))
def test_empty_events(spark, empty_events, name):
    rows = registered()[name](spark, empty_events).collect()
    if name == "scenario_totals":
        assert [tuple(row) for row in rows] == [(0, 0, 0, 0, 0)]
    elif name == "blacklist_scan":
        assert rows
    else:
        assert rows == []


@pytest.fixture(scope="module")
def split_tables(spark, tables, tmp_path_factory):
    """The events in several files of a folder, in no order of time."""
    folder = tmp_path_factory.mktemp("split")
    events = spark.read.parquet(f"{tables}/events.parquet")
    events.repartition(5, "user_id").write.parquet(str(folder / "events.parquet"))
    for name in ("customer", "supplier"):
        shutil.copy(f"{tables}/{name}.parquet", folder)
    return str(folder)


@pytest.mark.parametrize(
    "name", ["bot_detection", "csv_scan", "stream_bots", "stream_enrich", "stream_late_drop"]
)
def test_result_does_not_depend_on_the_files(spark, tables, split_tables, name):
    query = registered()[name]
    expected = query(spark, tables)
    actual = query(spark, split_tables).select(*expected.columns)
    assert sorted(map(str, actual.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("name", ["event_time", "bot_detection", "message_decode", "burst_explode"])
def test_result_does_not_depend_on_the_zone_of_the_session(spark, tables, name):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    query = registered()[name]
    expected = query(spark, tables).collect()
    assert sorted(map(str, query(other, tables).collect())) == sorted(map(str, expected))
