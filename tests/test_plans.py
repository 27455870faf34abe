"""Properties of the physical plans that matter at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from burstline.config import MessageSource
from burstline.operators.enrich import mark_blocked
from burstline.operators.prefilter import filter_words, split_likely
from burstline.plans.detection import detect_messages
from burstline.plans.table_queries import QUERIES
from burstline.schemas import BLACKLIST
from burstline.session import stateful_session
from burstline.sources.blacklist import read_blacklist, store_blacklist
from burstline.sources.messages import read_messages, write_messages
from burstline.sources.tables import (
    EVENTS_CONFIG,
    blacklist_from_accounts,
    messages_from_events,
    table,
    transactions_from_events,
)
from burstline.streaming import sinks
from burstline.streaming.compaction import compact
from burstline.streaming.replay import time_slices
from burstline.streaming.runner import StreamJob

BATCH = [name for name in QUERIES if not name.startswith("stream_")]


def plan_of(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain()
    return text.getvalue()


@pytest.fixture(scope="module")
def log(spark, tables, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plans")
    source = MessageSource("parquet", path=str(folder / "log"))
    write_messages(messages_from_events(table(spark, tables, "events")), source)
    accounts = blacklist_from_accounts(
        table(spark, tables, "customer"), table(spark, tables, "supplier")
    )
    store_blacklist(accounts, str(folder / "blacklist"))
    return source, str(folder / "blacklist")


@pytest.fixture(scope="module")
def outputs(spark, log):
    source, blacklist = log
    messages = spark.read.parquet(source.path)
    stored = read_blacklist(spark, blacklist)
    return detect_messages(messages, stored, EVENTS_CONFIG, already_unique=True)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, tables, name):
    plan = plan_of(QUERIES[name](spark, tables))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Collect"):
        assert node not in plan, node


@pytest.mark.parametrize(
    "name", ["normal_transactions", "fraud_alerts", "bot_detection", "summary_statistics"]
)
def test_each_message_is_parsed_once(outputs, name):
    assert plan_of(getattr(outputs, name)).count("from_json(") == 1


def test_message_scan_reads_the_value_only(outputs):
    assert "ReadSchema: struct<value:binary>" in plan_of(outputs.summary_statistics)


def test_detection_reads_few_columns(spark, tables):
    plan = plan_of(QUERIES["bot_detection"](spark, tables))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "PushedFilters: [IsNotNull(ts)]" in plan


def test_burst_detection_has_no_join(outputs):
    plan = plan_of(outputs.bot_detection)
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert plan.count("HashAggregate") == 2 and "partial_count" in plan


def test_sample_category_is_not_computed_unless_asked(spark, tables):
    assert "min(" not in plan_of(QUERIES["bot_detection"](spark, tables))
    sampled = plan_of(QUERIES["bot_sample_category"](spark, tables))
    assert "partial_min" in sampled and "SortAggregate" not in sampled


def test_stateless_outputs_do_not_shuffle(outputs):
    for output in (outputs.normal_transactions, outputs.fraud_alerts):
        plan = plan_of(output)
        assert plan.count("Exchange") == 1 and "BroadcastExchange" in plan


def test_filters_reach_below_the_join(outputs):
    plan = plan_of(outputs.normal_transactions)
    join, scan = plan.index("BroadcastHashJoin"), plan.index("Class#")
    assert join < scan and re.search(r"Filter .*Class#\d+ = 0", plan[join:])


def test_summary_aggregates_panes_before_windows(outputs):
    plan = plan_of(outputs.summary_statistics)
    assert plan.count("HashAggregate") == 4 and plan.count("Expand") == 1
    assert plan.index("Expand") < plan.index("BroadcastHashJoin")


def test_large_blacklist_is_not_broadcast(spark, log, tables):
    transactions = transactions_from_events(table(spark, tables, "events"))
    blacklist = read_blacklist(spark, log[1])
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = plan_of(mark_blocked(transactions, blacklist, already_unique=True))
    finally:
        spark.conf.set(limit, before)
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_salted_blacklist_is_never_broadcast(spark, log, tables):
    transactions = transactions_from_events(table(spark, tables, "events"))
    joined = mark_blocked(transactions, read_blacklist(spark, log[1]), True, salt_buckets=8)
    plan = plan_of(joined)
    assert "Broadcast" not in plan
    assert re.search(r"SortMergeJoin \[User_ID#\d+, _salt#\d+L\]", plan)


def test_filter_keeps_most_rows_out_of_the_shuffle(spark, log, tables):
    transactions = transactions_from_events(table(spark, tables, "events"))
    blacklist = read_blacklist(spark, log[1])
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        joined = mark_blocked(transactions, blacklist, already_unique=True, bloom_words=1 << 12)
        joined.collect()
        plan = plan_of(joined)
        # The filter is broadcast by its bound; of the list and the rows only likely ones move.
        assert "BroadcastHashJoin [_filter_word#" in plan and "SortMergeJoin [User_ID#" in plan
        assert not re.search(r"BroadcastHashJoin \[User_ID", plan)
        final = plan[: plan.index("== Initial Plan ==")]
        side = final[final.index("SortMergeJoin") : final.rindex("SortMergeJoin") + 3000]
        assert re.search(r"Exchange hashpartitioning\(User_ID#\d+.*\n.*(Project|Filter)", side)
        likely, others = split_likely(
            transactions, filter_words(blacklist, "User_ID", 1 << 12), "User_ID", 1 << 12
        )
        listed = transactions.join(blacklist, "User_ID", "left_semi").count()
        total = transactions.count()
        assert listed <= likely.count() < listed + 0.02 * total
        assert likely.count() + others.count() == total


def test_undecodable_rows_are_not_joined(spark, log):
    rows = spark.range(0, 1000, 1, 8).selectExpr(
        "CAST(NULL AS string) AS User_ID", "CAST(NULL AS string) AS Transaction_ID",
        "CAST(NULL AS timestamp) AS event_time", "CAST(NULL AS double) AS Amount",
    )
    blacklist = read_blacklist(spark, log[1])
    likely, others = split_likely(rows, filter_words(blacklist, "User_ID"), "User_ID")
    assert likely.count() == 0 and others.count() == 1000
    with settings(spark, spark__sql__adaptive__enabled="false"):
        for ways in ({"bloom_words": 64}, {"salt_buckets": 8}):
            joined = mark_blocked(rows, blacklist, True, **ways)
            assert joined.filter("User_Status = 'ACTIVE'").count() == 1000
        # The salted join deals them out.
        parts = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1


@contextlib.contextmanager
def settings(session, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: session.conf.get(name, None) for name in names}
    for name, value in names.items():
        session.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            session.conf.unset(name) if value is None else session.conf.set(name, value)


@pytest.mark.parametrize("already_unique", [False, True])
def test_hot_user_of_a_shuffled_join_is_split(spark, already_unique):
    rows = spark.range(0, 400_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('u', id % 1000)) AS User_ID",
        "CAST(id AS string) AS Transaction_ID",
        "id * 0.5 AS Amount",
    )
    blacklist = spark.createDataFrame(
        [("hot", "reason", "2024-01-01"), ("u1", "other", "2024-01-01")], BLACKLIST
    )
    off = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__shuffle__partitions": "16",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "100KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "200KB",
        "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    }
    with settings(spark, **off):
        joined = mark_blocked(rows, blacklist, already_unique)
        blocked = joined.filter("User_Status = 'BLOCKED'")
        joined.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(joined)
        hot = len(range(0, 400_000, 3))
        others = sum(1 for i in range(1, 400_000, 1000) if i % 3)
        assert blocked.count() == hot + others


def test_replay_slices_filter_in_the_scan(spark, tables):
    first, middle, *_ = time_slices(table(spark, tables, "events"), "ts", 4)
    assert "LessThan(ts,2024-01-" in plan_of(first)
    assert "GreaterThanOrEqual(ts,2024-01-" in plan_of(middle)


def test_unique_blacklist_makes_an_unused_join_vanish(spark, tables):
    transactions = transactions_from_events(table(spark, tables, "events"))
    accounts = blacklist_from_accounts(
        table(spark, tables, "customer"), table(spark, tables, "supplier")
    )
    joined = mark_blocked(transactions, accounts).groupBy("User_ID").agg(F.count("*"))
    assert "Join" not in plan_of(joined)


def test_latest_state_is_a_hash_aggregation(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([("k", 1, 2.0)], "key string, n long, x double")
    for batch in range(4):
        rows.write.parquet(f"{path}/batch_id={batch}")
    plan = plan_of(sinks.latest(spark, path, ["key"]))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    compact(spark, path, ["key"])
    rows.write.parquet(f"{path}/batch_id=4")
    newest = sinks.latest(spark, path, ["key"])
    # One base and the batches after it.
    read = {file.split("/log/")[1].rsplit("/", 1)[0] for file in newest.inputFiles()}
    assert len(read) == 2 and "batch_id=4" in read and any(r.startswith("_base/3-") for r in read)
    assert "HashAggregate" in plan_of(newest) and "SortAggregate" not in plan_of(newest)


def streaming_plan(session, log, pick, folder, config=EVENTS_CONFIG):
    source, path = log
    messages = read_messages(session, source)
    blacklist = read_blacklist(session, path)
    output = pick(detect_messages(messages, blacklist, config, already_unique=True))
    job = StreamJob("plan", output, "update", sinks.change_log(str(folder / "o")), str(folder / "c"))
    return plan_of(job.drain())


def test_stateful_summary_stream_joins_by_broadcast(spark, log, tmp_path):
    session = stateful_session(spark, 3)
    plan = streaming_plan(session, log, lambda o: o.summary_statistics, tmp_path)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "StateStoreSave" in plan and ", 3)" in plan and plan.count("from_json(") == 1


def test_stateful_burst_stream_has_no_join(spark, log, tmp_path):
    session = stateful_session(spark, 3)
    plan = streaming_plan(session, log, lambda o: o.bot_detection, tmp_path)
    assert "Join" not in plan and "partial_count" in plan


def test_stateful_stream_with_a_large_blacklist_is_salted(spark, log, tmp_path):
    session = stateful_session(spark, 3)
    source, path = log

    def summary(messages):
        blacklist = read_blacklist(session, path)
        return detect_messages(
            messages, blacklist, EVENTS_CONFIG, already_unique=True, salt_buckets=4
        ).summary_statistics

    out = str(tmp_path / "o")
    stream = summary(read_messages(session, source))
    job = StreamJob("salted", stream, "update", sinks.change_log(out), str(tmp_path / "c"))
    plan = plan_of(job.drain())
    assert re.search(r"SortMergeJoin \[User_ID#\d+, _salt#\d+L\]", plan)
    counts = ["window", "total_transactions", "blocked_count"]
    streamed = sinks.latest(session, out, ["window"]).select(*counts).collect()
    batch = summary(session.read.parquet(source.path)).select(*counts).collect()
    assert sorted(streamed) == sorted(batch) and sum(r.blocked_count for r in batch) > 0


def test_stateful_stream_with_a_filtered_blacklist(spark, log, tmp_path):
    session = stateful_session(spark, 3)
    source, path = log

    def summary(messages):
        blacklist = read_blacklist(session, path)
        return detect_messages(
            messages, blacklist, EVENTS_CONFIG, already_unique=True, bloom_words=256
        ).summary_statistics

    out = str(tmp_path / "o")
    with settings(session, spark__sql__autoBroadcastJoinThreshold="-1"):
        stream = summary(read_messages(session, source))
        job = StreamJob("filtered", stream, "update", sinks.change_log(out), str(tmp_path / "c"))
        plan = plan_of(job.drain())
    assert "SortMergeJoin [User_ID#" in plan and "Union" in plan
    counts = ["window", "total_transactions", "blocked_count"]
    streamed = sinks.latest(session, out, ["window"]).select(*counts).collect()
    batch = summary(session.read.parquet(source.path)).select(*counts).collect()
    assert sorted(streamed) == sorted(batch) and sum(r.blocked_count for r in batch) > 0
