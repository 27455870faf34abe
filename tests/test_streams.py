import json
import time
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from burstline.config import DetectionConfig, MessageSource
from burstline.operators.decode import decode_for_detection, deduplicated
from burstline.operators.enrich import categorize
from burstline.operators.feed import envelope
from burstline.operators.windows import bot_detection, closed_summary, summary_statistics
from burstline.plans.detection import (
    OUTPUTS,
    detect_messages,
    detection_jobs,
    refreshed_routes,
)
from burstline.plans.feeding import feed
from burstline.schemas import BLACKLIST
from burstline.session import stateful_session
from burstline.sources.blacklist import read_blacklist, store_blacklist, store_initial_blacklist
from burstline.sources.messages import (
    read_messages,
    scan_messages,
    write_messages,
    write_run,
)
from burstline.sources.tables import table_stream
from burstline.streaming import late, sinks, state
from burstline.streaming.progress import FeedProgress, observe_totals
from burstline.streaming.replay import time_slices
from burstline.streaming.runner import StreamJob, start_all, stop_all, supervise
from burstline.streaming.workspace import run_folder, shared_root
from tests.conftest import at

EVERY = DetectionConfig(bot_more_than=0)


@pytest.fixture(scope="module")
def live(spark):
    return stateful_session(spark, state_partitions=2)


class Lines:
    """JSON text files, one per batch, in a folder read as a stream."""

    def __init__(self, spark, folder):
        folder.mkdir()
        self.folder, self.count = folder, 0
        source = MessageSource("text", path=str(folder), options={"maxFilesPerTrigger": "1"})
        self.messages = read_messages(spark, source)

    def add(self, *rows):
        text = "\n".join(json.dumps(row) for row in rows)
        (self.folder / f"{self.count:03d}.json").write_text(text, encoding="utf-8")
        self.count += 1
        time.sleep(0.05)

    def at(self, *times, user="B", amount=1.0, label=0):
        self.add(
            *(
                {
                    "Transaction_ID": f"{self.count}-{i}",
                    "User_ID": user,
                    "Timestamp": time.isoformat(),
                    "Amount": amount,
                    "Class": label,
                }
                for i, time in enumerate(times)
            )
        )


def job(name, output, mode, sink, folder, every=None):
    return StreamJob(name, output, mode, sink, str(folder / f"checkpoint-{name}"), every)


def emitted(live, path):
    """(batch, window start, count) of every change."""
    rows = live.read.parquet(path).collect()
    return sorted((r.batch_id, r.window_start, r.transaction_count) for r in rows)


def test_late_rows_drop_one_batch_after_the_watermark_moves(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    alerts = bot_detection(decode_for_detection(lines.messages), EVERY)
    path = str(tmp_path / "out")
    query = job("late", alerts, "update", sinks.change_log(path), tmp_path, "0 seconds").start()
    dropped = []
    files = [
        [at(0, 1)] * 4,
        [at(1, 0)],
        [at(1, 1)],
        [at(0, 3), at(0, 3), at(0, 45)],
        [at(1, 2)],
    ]
    try:
        for times in files:
            lines.at(*times)
            query.processAllAvailable()
            data = [p for p in query.recentProgress if p.numInputRows]
            dropped.append(sum(o.numRowsDroppedByWatermark for o in data[-1].stateOperators))
    finally:
        query.stop()
    counts = {}
    for batch, start, count in emitted(live, path):
        counts.setdefault(batch, []).append((start, count))
    before = at(0, 0).replace(year=2023, month=12, day=31, hour=23, minute=59, second=55)
    assert [c for c in counts.values() if c] == [
        [(before, 4), (at(0, 0), 4)],
        [(at(0, 55), 1), (at(1, 0), 1)],
        [(at(0, 55), 2), (at(1, 0), 2)],
        [(at(0, 40), 1), (at(0, 45), 1)],
        [(at(0, 55), 3), (at(1, 0), 3)],
    ]
    assert dropped == [0, 0, 0, 2, 0]


def test_update_output_is_a_change_log(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    path = str(tmp_path / "out")
    alerts = bot_detection(decode_for_detection(lines.messages))
    log = job("changes", alerts, "update", sinks.change_log(path), tmp_path)
    for size in (4, 1, 2):
        lines.at(*[at(0, 6)] * size)
        log.drain()
    assert [count for _, _, count in emitted(live, path)] == [5, 5, 7, 7]
    keys = ["window_start", "window_end", "User_ID", "Alert_Status"]
    rows = sinks.latest(live, path, keys).collect()
    assert {r.window_start: r.transaction_count for r in rows} == {at(0, 0): 7, at(0, 5): 7}


def test_append_mode_gives_closed_windows_once(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    alerts = bot_detection(decode_for_detection(lines.messages), EVERY)
    closed = job("closed", alerts, "append", sinks.files(str(tmp_path / "out")), tmp_path)
    for minute in (0, 0, 1, 2):
        lines.at(at(minute, 6))
        closed.drain()
    rows = live.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.window_start, r.transaction_count) for r in rows) == [
        (at(0, 0), 2), (at(0, 5), 2), (at(1, 0), 1), (at(1, 5), 1)
    ]


def test_replayed_batch_replaces_itself(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    path = str(tmp_path / "out")
    output = categorize(decode_for_detection(lines.messages))
    summary = summary_statistics(output.withColumn("User_Status", F.lit("ACTIVE")))
    lines.at(at(0, 1), amount=5.0)

    def store_and_lose(changes, batch):
        changes.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")
        raise RuntimeError("lost")

    def losing(writer):
        return writer.foreachBatch(store_and_lose)

    failing = job("replay", summary, "update", losing, tmp_path)
    with pytest.raises(StreamingQueryException):
        failing.drain()
    stored = live.read.parquet(path).count()
    assert stored == 3
    sound = job("replay", summary, "update", sinks.change_log(path), tmp_path)
    sound.drain()
    lines.at(at(0, 2), amount=7.0)
    sound.drain()
    rows = sinks.latest(live, path, ["window"]).collect()
    assert {(r.total_transactions, r.total_amount) for r in rows} == {(2, 12.0)}


def test_files_of_a_change_batch(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    path = tmp_path / "out"
    alerts = bot_detection(decode_for_detection(lines.messages), EVERY)
    lines.at(*[at(minute) for minute in range(40)])
    job("few", alerts, "update", sinks.change_log(str(path), 1), tmp_path).drain()
    assert len(list((path / "batch_id=0").glob("*.parquet"))) == 1
    assert live.read.parquet(str(path)).count() == 80


def test_append_rows_once_over_a_restart(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    path = str(tmp_path / "out")
    output = decode_for_detection(lines.messages)
    copy = job("append", output, "append", sinks.files(path), tmp_path)
    for minute in range(3):
        lines.at(at(minute), at(minute, 1))
        copy.drain()
    assert live.read.parquet(path).count() == 6


def fill(spark, folder):
    """Messages of a small feed and the initial blacklist."""
    rows = spark.range(400).select(
        F.col("id").alias("row"),
        F.timestamp_seconds(F.col("id") * 3).alias("event_time"),
        (F.col("id") * 2.5).alias("Amount"),
        F.when(F.col("id") % 50 == 3, 1).otherwise(0).alias("Class"),
    )
    log = MessageSource("parquet", path=str(folder / "log"))
    write_messages(envelope(feed(rows, "row")), log)
    store_initial_blacklist(spark, str(folder / "blacklist"))
    return log


def outputs_of(session, messages, folder):
    blacklist = read_blacklist(session, str(folder / "blacklist"))
    return detect_messages(messages, blacklist, already_unique=True)


def table_sink(folder):
    def sink(name):
        path = str(folder / name)
        if OUTPUTS.get(name, ("append",))[0] == "update":
            return sinks.change_log(path)
        return sinks.files(path)

    return sink


def test_all_queries_equal_their_batch_twins(spark, live, tmp_path):
    log = fill(spark, tmp_path)
    batch = outputs_of(live, live.read.parquet(log.path), tmp_path)
    streams = outputs_of(live, read_messages(live, log), tmp_path)
    out = tmp_path / "out"
    supervise(start_all(detection_jobs(streams, str(tmp_path), table_sink(out), live=False)))
    for name, (mode, _, _) in OUTPUTS.items():
        expected = getattr(batch, name)
        stored = live.read.parquet(str(out / name)).select(*expected.columns)
        assert sorted(map(str, stored.collect())) == sorted(map(str, expected.collect())), name
        assert (tmp_path / "checkpoints" / name).exists() and mode in ("append", "update")
    assert batch.fraud_alerts.count() == 8 and batch.bot_detection.count() > 0


def test_folded_routes_equal_the_two_outputs(spark, live, tmp_path):
    log = fill(spark, tmp_path)
    streams = outputs_of(live, read_messages(live, log), tmp_path)
    out = tmp_path / "out"
    jobs = detection_jobs(streams, str(tmp_path), table_sink(out), live=False, fold_routes=True)
    assert [j.name for j in jobs] == ["routed_transactions", "bot_detection", "summary_statistics"]
    jobs[0].drain()
    routed = live.read.parquet(str(out / "routed_transactions"))
    batch = outputs_of(live, live.read.parquet(log.path), tmp_path)
    for route, twin in [("normal", batch.normal_transactions), ("alert", batch.fraud_alerts)]:
        rows = routed.filter(F.col("Route") == route).select(*twin.columns)
        assert sorted(map(str, rows.collect())) == sorted(map(str, twin.collect()))


def test_live_triggers_and_console(spark, live, tmp_path):
    log = fill(spark, tmp_path)
    streams = outputs_of(live, read_messages(live, log), tmp_path)
    jobs = detection_jobs(streams, str(tmp_path), lambda name: sinks.console(rows=5))
    assert [j.every for j in jobs] == ["5 seconds", "3 seconds", "5 seconds", "10 seconds"]
    queries = start_all(jobs[1:2])
    try:
        assert [q.name for q in queries] == ["fraud_alerts"]
        queries[0].processAllAvailable()
    finally:
        stop_all(queries)
    batches = [p for p in queries[0].recentProgress if p.numInputRows]
    assert batches and "Console" in batches[0].sink.description


def test_a_repeated_batch_takes_the_list_it_had(spark, live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    listed, path = str(tmp_path / "list"), str(tmp_path / "routed")

    def drain():
        refreshed_routes(lines.messages, listed, path, str(tmp_path), live=False).drain()
        rows = live.read.parquet(path).collect()
        return sorted((r.batch_id, r.Route, r.Block_Reason) for r in rows)

    def store(user):
        rows = [(user, f"{user} listed", "2024-01-01")]
        store_blacklist(live.createDataFrame(rows, BLACKLIST), listed)

    store("B")
    lines.at(at(0), at(1), user="B")
    assert drain() == [(0, "alert", "B listed")] * 2
    store("C")
    # The batch was stored but its commit was lost: it comes again, with the list of its own.
    for file in (tmp_path / "checkpoints" / "routed_transactions" / "commits").glob("*0*"):
        file.unlink()
    assert drain() == [(0, "alert", "B listed")] * 2
    lines.at(at(2), user="B")
    assert drain() == [(0, "alert", "B listed")] * 2 + [(1, "normal", None)]


def test_counted_and_late_rows_are_all_rows(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    path, window = str(tmp_path / "split"), EVERY.bot_window
    output = decode_for_detection(lines.messages)

    def drain():
        sink = late.late_and_counted(path, window, ["User_ID"], "Amount")
        job("split", output, "append", sink, tmp_path).drain()

    lines.at(at(0, 1), at(0, 1), at(1, 0))
    drain()
    # The watermark is at 0:40 now: of the first, both windows are closed, of the second, one.
    lines.at(at(0, 3), at(0, 34), at(0, 45), at(2, 0))
    drain()
    lines.add({"Transaction_ID": "x", "User_ID": "B", "Amount": 1.0})
    drain()
    counted = late.counted_windows(live, path, ["User_ID"]).collect()
    gone = late.late_rows(live, path).collect()
    assert sorted((r.event_time, r.window.start) for r in gone) == [
        (at(0, 3), at(0, 0).replace(year=2023, month=12, day=31, hour=23, minute=59, second=55)),
        (at(0, 3), at(0, 0)),
        (at(0, 34), at(0, 25)),
        (at(0, 34), at(0, 30)),
    ]
    assert {r.batch_id for r in gone} == {1}
    # Two windows a row; the row without a time is in none.
    assert sum(r.n for r in counted) + len(gone) == 2 * 7
    assert sum(r.amount for r in counted) == sum(r.n for r in counted)


def test_a_repeated_batch_judges_as_before(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    path, window = str(tmp_path / "split"), EVERY.bot_window
    output = decode_for_detection(lines.messages)

    def drain():
        sink = late.late_and_counted(path, window, ["User_ID"], "Amount")
        job("split", output, "append", sink, tmp_path).drain()
        counted = late.counted_windows(live, path, ["User_ID"]).collect()
        return sum(r.n for r in counted), late.late_rows(live, path).count()

    lines.at(at(0, 1), at(3, 0))
    assert drain() == (4, 0)
    lines.at(at(0, 2), at(5, 0))
    assert drain() == (6, 2)
    for file in (tmp_path / "checkpoint-split" / "commits").glob("*1*"):
        file.unlink()
    assert drain() == (6, 2)


def test_closed_windows_once_by_chained_state(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    enriched = categorize(decode_for_detection(lines.messages)).withColumn(
        "User_Status", F.lit("ACTIVE")
    )
    path = str(tmp_path / "out")
    closed = job("panes", closed_summary(enriched), "append", sinks.files(path), tmp_path)
    for minute in (0, 0, 2, 4):
        lines.at(at(minute, 6), at(minute, 17), amount=2.5)
        query = closed.drain()
    state = [o.operatorName for p in query.recentProgress for o in p.stateOperators]
    assert state.count("stateStoreSave") >= 2
    rows = {r.window.start: r for r in live.read.parquet(path).collect()}
    early = [rows[start] for start in sorted(rows) if start < at(1)]
    day = {"year": 2023, "month": 12, "day": 31, "hour": 23, "minute": 59}
    assert [(r.window.start, r.total_transactions, r.total_amount) for r in early] == [
        (at(0).replace(**day, second=40), 2, 5.0),
        (at(0).replace(**day, second=50), 4, 10.0),
        (at(0), 4, 10.0),
        (at(0, 10), 2, 5.0),
    ]
    assert {r.avg_amount for r in early} == {2.5} and all(start < at(4) for start in rows)
    with pytest.raises(ValueError, match="whole number"):
        odd = replace(EVERY.summary_window, slide=timedelta(seconds=7))
        closed_summary(enriched, EVERY.but(summary_window=odd))


def test_state_of_a_stopped_query(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    alerts = bot_detection(decode_for_detection(lines.messages))
    log = job("held", alerts, "update", sinks.change_log(str(tmp_path / "out")), tmp_path)
    for minute in (0, 1):
        lines.at(*[at(minute, 6)] * 3, amount=2.0)
        log.drain()
    checkpoint = str(tmp_path / "checkpoint-held")
    measures = {"count": "n", "sum": "amount"}
    # Three a window are no alert, but they are in the state; the first ones are closed.
    held = state.open_windows(live, checkpoint, measures).collect()
    assert sorted(map(tuple, held)) == [
        (at(1, 0), at(1, 10), "B", 3, 6.0), (at(1, 5), at(1, 15), "B", 3, 6.0)
    ]
    before = state.open_windows(live, checkpoint, measures, batch=0).collect()
    assert {r.window_start for r in before} == {at(0, 0), at(0, 5)}
    operators = state.state_operators(live, checkpoint).collect()
    assert [r.operatorName for r in operators] == ["stateStoreSave"]


def test_messages_sent_again_are_read_once(spark, live, tmp_path):
    target = MessageSource("parquet", path=str(tmp_path / "log"))
    rows = spark.range(50).select(
        F.concat(F.lit("T"), F.col("id")).alias("Transaction_ID"),
        F.lit("u").alias("User_ID"),
        F.date_format(F.timestamp_seconds(F.col("id") + 1000), "yyyy-MM-dd'T'HH:mm:ss").alias("Timestamp"),
    )
    keyed = envelope(rows)
    for _ in range(2):  # the same run replaces itself
        write_run(keyed, target, "1")
    assert scan_messages(spark, target).count() == 50
    messages = decode_for_detection(read_messages(live, target))
    path = str(tmp_path / "out")

    def drain():
        output = deduplicated(messages, timedelta(hours=1))
        job("once", output, "append", sinks.files(path), tmp_path).drain()
        return sorted((r.Transaction_ID or "") for r in live.read.parquet(path).collect())

    once = sorted(f"T{k}" for k in range(50))
    assert drain() == once
    write_run(keyed, target, "1")
    write_run(keyed, target, "2")
    odd = live.createDataFrame([(b"{}",), (b"{}",), (b'{"Transaction_ID":"T1"}',)], "value binary")
    write_run(odd.withColumn("key", F.lit(None).cast("binary")), target, "odd")
    # What cannot be told apart stays.
    assert drain() == sorted(["", "", "T1", *once])
    for name in ("", "a/b", "_hidden"):
        with pytest.raises(ValueError):
            write_run(keyed, target, name)


class _Writer:
    """Records what a sink sets."""

    def __init__(self):
        self.settings = {}

    def format(self, name):
        return self.option("format", name)

    def option(self, key, value):
        self.settings[key] = value
        return self


def test_console_shows_as_many_rows_as_asked():
    writer = _Writer()
    sinks.console(rows=30)(writer)
    assert writer.settings == {"format": "console", "numRows": 30, "truncate": False}


def test_failure_of_any_query_stops_the_others(spark, live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    lines.at(at(0))
    good = decode_for_detection(lines.messages)
    bad = good.withColumn("Amount", F.raise_error(F.lit("broken")).cast("double"))
    jobs = [
        job("good", good, "append", sinks.files(str(tmp_path / "g")), tmp_path, "1 second"),
        job("bad", bad, "append", sinks.files(str(tmp_path / "b")), tmp_path, "1 second"),
    ]
    queries = start_all(jobs)
    with pytest.raises(StreamingQueryException, match="broken"):
        supervise(queries)
    assert not any(q.isActive for q in queries)


def test_a_job_that_cannot_start_stops_the_started(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    output = decode_for_detection(lines.messages)
    good = job("first", output, "append", sinks.files(str(tmp_path / "g")), tmp_path, "1 second")
    wrong = job("second", output, "complete", sinks.memory(), tmp_path)
    with pytest.raises(Exception, match="(?i)complete"):
        start_all([good, wrong])
    assert not live.streams.active


def test_message_sink(live, tmp_path):
    lines = Lines(live, tmp_path / "in")
    lines.at(at(0), at(1), user="u")
    target = MessageSource("parquet", path=str(tmp_path / "out"))
    keyed = envelope(decode_for_detection(lines.messages).drop("event_time"))
    job("messages", keyed, "append", sinks.messages(target), tmp_path).drain()
    rows = live.read.parquet(target.path).collect()
    assert [bytes(r.key) for r in rows] == [b"u", b"u"]


def test_feed_stream_reports_totals(spark, live, tables, tmp_path):
    events = table_stream(live, tables, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("Class"),
    )
    sent = observe_totals(feed(events, "event_id"))
    progress = FeedProgress()
    live.streams.addListener(progress)
    try:
        path = str(tmp_path / "out")
        job("feed", envelope(sent), "append", sinks.files(path), tmp_path).drain()
        deadline = time.time() + 20
        while not progress.totals and time.time() < deadline:
            time.sleep(0.1)
    finally:
        live.streams.removeListener(progress)
    totals = progress.totals
    assert totals["total_sent"] == live.read.parquet(path).count()
    assert totals["total_sent"] == (
        totals["normal_count"] + totals["fraud_count"] + totals["bot_transactions"]
    )


def test_time_slices_cover_everything_once(spark, tables):
    events = spark.read.parquet(f"{tables}/events.parquet")
    parts = [{r.event_id for r in part.collect()} for part in time_slices(events, "ts", 4)]
    assert len(parts) == 4 and all(parts)
    assert sum(map(len, parts)) == len(set().union(*parts)) == events.count()
    assert [part.count() for part in time_slices(events.limit(0), "ts", 4)] == [0]


class _Session:
    """Stands in for a session on some master, with the settings given."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master})()


def test_shared_root_comes_from_the_session():
    session = _Session("spark://host:7077", **{"spark.checkpoint.dir": "/shared/folder/"})
    assert shared_root(session) == "/shared/folder"
    first, second = run_folder(session, "a"), run_folder(session, "a")
    assert first.startswith("/shared/folder/burstline/a-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(_Session("spark://host:7077"))
    assert shared_root(_Session("local[2]"))
