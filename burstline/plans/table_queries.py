"""Every operator as a query over the given tables: name -> function(spark, table folder)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from burstline.config import MessageSource, SlidingWindow
from burstline.functions.identity import iso_text
from burstline.operators.decode import (
    decode_for_detection,
    decode_json,
    deduplicated,
    with_event_time,
)
from burstline.operators.enrich import categorize, enrich
from burstline.operators.feed import assign_scenario, envelope, normalize, totals
from burstline.operators.prefilter import WORDS
from burstline.operators.route import fraud_alerts, normal_transactions, unrouted, with_route
from burstline.operators.windows import (
    bot_detection,
    bot_windows,
    closed_summary,
    flat_window,
    summary_statistics,
)
from burstline.plans.detection import Detection, detect_messages, refreshed_routes
from burstline.plans.feeding import feed
from burstline.schemas import COMPONENTS, DETECTION_FIELDS, MESSAGE
from burstline.session import SETTINGS, stateful_session
from burstline.sources.blacklist import read_blacklist, store_blacklist, unique_blacklist
from burstline.sources.csv_rows import read_csv_rows
from burstline.sources.messages import (
    read_messages,
    scan_messages,
    write_messages,
    write_run,
)
from burstline.sources.quarantine import split_rows
from burstline.sources.tables import (
    BATCH_BYTES,
    EVENTS_CONFIG,
    blacklist_from_accounts,
    messages_from_events,
    table,
    table_stream,
    transactions_from_events,
    without_zone,
)
from burstline.streaming.compaction import Compaction, vacuum
from burstline.streaming.late import late_and_counted, late_rows
from burstline.streaming.replay import time_slices
from burstline.streaming.runner import StreamJob
from burstline.streaming.sinks import change_log, files, latest
from burstline.streaming.sinks import messages as messages_sink
from burstline.streaming.state import open_windows
from burstline.streaming.workspace import run_folder

Query = Callable[[SparkSession, str], DataFrame]

REPLAY_SLICES = 4
LATE_TYPE = "signup"
LATE_CONFIG = EVENTS_CONFIG.but(
    bot_window=SlidingWindow(timedelta(days=1), timedelta(hours=12), timedelta(days=1))
)
_BOT_KEYS = ["window_start", "window_end", "User_ID", "Alert_Status"]
_SUMMARY_KEYS = ["window_start", "window_end"]
_CENTS = ["total_amount"]


def _rounded(frame: DataFrame, names: list[str] = _CENTS) -> DataFrame:
    """Sums of doubles depend on their order in the last bits."""
    return frame.withColumns({name: F.round(name, 2) for name in names})


# -- batch ------------------------------------------------------------------------------


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(table(spark, sf_dir, "events"))


def _blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blacklist_from_accounts(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    )


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_transactions(spark, sf_dir), _blacklist(spark, sf_dir), EVENTS_CONFIG)


def q_categorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    categorized = categorize(_transactions(spark, sf_dir), EVENTS_CONFIG)
    return categorized.select("Transaction_ID", "Amount", "Category")


def q_blacklist_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_blacklist(_blacklist(spark, sf_dir))


def q_blacklist_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


def q_blacklist_join_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions, blacklist = _transactions(spark, sf_dir), _blacklist(spark, sf_dir)
    return enrich(transactions, blacklist, EVENTS_CONFIG, salt_buckets=8)


def q_blacklist_join_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions, blacklist = _transactions(spark, sf_dir), _blacklist(spark, sf_dir)
    return enrich(transactions, blacklist, EVENTS_CONFIG, bloom_words=WORDS)


def q_normal_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normal_transactions(_enriched(spark, sf_dir), EVENTS_CONFIG)


def q_fraud_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud_alerts(_enriched(spark, sf_dir))


def q_unrouted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = unrouted(_enriched(spark, sf_dir), EVENTS_CONFIG)
    return rest.select("Transaction_ID", "User_ID", "Class", "User_Status")


def q_route_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = with_route(_enriched(spark, sf_dir), EVENTS_CONFIG)
    return _rounded(
        routed.groupBy("Route").agg(
            F.count("*").alias("transactions"), F.sum("Amount").alias("total_amount")
        )
    )


def q_bot_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(bot_detection(_transactions(spark, sf_dir), EVENTS_CONFIG))


def q_bot_sample_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    categorized = categorize(_transactions(spark, sf_dir), EVENTS_CONFIG)
    alerts = bot_windows(categorized, EVENTS_CONFIG, sample_category=True)
    return alerts.select("window_start", "window_end", "User_ID", "sample_category")


def q_summary_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_window(summary_statistics(_enriched(spark, sf_dir), EVENTS_CONFIG))


def q_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    messages = events.select(F.col("props").cast("binary").alias("value"))
    return decode_json(messages, StructType([StructField("k", IntegerType())]))


def q_message_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_json(messages_from_events(table(spark, sf_dir, "events")))
    return with_event_time(decoded).select(*DETECTION_FIELDS, "event_time")


def q_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with and without fraction, unreadable and empty ones, by event type."""
    kind, instant = F.col("event_type"), F.col("ts").cast("timestamp")
    text = (
        F.when(kind == "view", F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == "signup", F.concat(F.lit("garbage "), F.col("event_id")))
        .when(kind == "purchase", F.lit(""))
        .otherwise(iso_text(instant))
    )
    events = table(spark, sf_dir, "events").select("event_id", text.alias("Timestamp"))
    return with_event_time(events)


def _by_type(default: Column, **variants: Column) -> Column:
    choice = None
    for kind, value in variants.items():
        hit = F.col("event_type") == kind
        choice = F.when(hit, value) if choice is None else choice.when(hit, value)
    return choice.otherwise(default)


def q_csv_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    number, amount = F.col("event_id").cast("string"), F.col("value").cast("string")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        _by_type(number, view=F.lit(None)).alias("Time"),
        _by_type(
            amount,
            view=F.lit("1_000"),
            click=F.lit("abc"),
            signup=F.lit("1d"),
            purchase=F.concat(F.lit(" +"), amount, F.lit(" ")),
        ).alias("V1"),
        amount.alias("Amount"),
        _by_type(F.lit("0"), error=F.lit("1"), view=F.lit(""), click=F.lit("x1")).alias("Class"),
        _by_type(F.lit("noted"), signup=F.lit(None)).alias("Remark"),
    )
    return normalize(rows, ["Time", "V1", "Amount", "Class", "Remark"], strict=False)


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged CSV text made from the whole table, then scanned: signup rows are short and
    dropped, view rows carry surplus fields, purchase rows quote a comma."""
    number, amount = F.col("event_id").cast("string"), F.col("value").cast("string")
    line = _by_type(
        F.concat_ws(",", number, amount, amount, F.lit("0")),
        signup=F.concat_ws(",", number, amount, amount),
        view=F.concat_ws(",", number, amount, amount, F.lit("0"), F.lit("more"), number),
        purchase=F.concat_ws(",", number, F.lit('"1,5"'), amount, F.lit('"0"')),
        click=F.concat_ws(",", number, amount, F.lit(""), F.lit("")),
        error=F.concat_ws(",", number, F.lit('"a ""b"", c"'), amount, F.lit("1"), F.lit('"x,y"')),
    )
    columns = ["Time", "V1", "Amount", "Class"]
    path = run_folder(spark, "csv")
    _write_lines(table(spark, sf_dir, "events").select(line), ",".join(columns), path)
    return normalize(read_csv_rows(spark, path, columns), columns).select(*columns)


def _write_lines(lines: DataFrame, header: str, path: str) -> None:
    """CSV files from lines as they are: one unquoted column whose name is the header line."""
    lines.toDF(header).write.options(
        header=True, sep="\u0001", quote="", escapeQuotes=False
    ).csv(path)


def q_csv_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three kinds of files in one folder, each with a header of its own: columns in another
    order, and one kind without ``V1``."""
    number, cents = F.col("event_id").cast("string"), F.round(F.col("value") * 100).cast("bigint")
    kind = F.col("event_type")
    label = F.when(kind == "error", "1").otherwise("0")
    files = {
        "Time,V1,Amount,Class": (kind.isin("view", "click"), [number, number, cents, label]),
        "Class,Amount,Time": (kind == "purchase", [label, cents, number]),
        "Amount,Class,V1,Time": (
            ~kind.isin("view", "click", "purchase"), [cents, label, number, number]
        ),
    }
    path = run_folder(spark, "csv_layouts")
    for k, (header, (some, fields)) in enumerate(files.items()):
        rows = table(spark, sf_dir, "events").filter(some)
        _write_lines(rows.select(F.concat_ws(",", *fields)), header, f"{path}/kind-{k}")
    rows = read_csv_rows(spark, path, ["Time", "V1", "Amount", "Class"])
    return rows.select(
        F.col("Time").cast("double").alias("Time"),
        F.col("V1").cast("double").alias("V1"),
        F.col("Amount").cast("double").alias("Amount"),
        F.col("Class").cast("int").alias("Class"),
    )


def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a CSV that are refused, and why: signup rows are short, view rows open a
    quote, click rows have no number for a label."""
    number, cents = F.col("event_id").cast("string"), F.round(F.col("value") * 100).cast("bigint")
    line = _by_type(
        F.concat_ws(",", number, cents, F.lit("0")),
        signup=F.concat_ws(",", number, cents),
        view=F.concat(number, F.lit(',"'), cents, F.lit(",0")),
        click=F.concat_ws(",", number, cents, F.lit("x1")),
        error=F.concat_ws(",", number, cents, F.lit("1"), F.lit("more")),
    )
    path = run_folder(spark, "csv_quarantine")
    _write_lines(table(spark, sf_dir, "events").select(line), "Time,Amount,Class", f"{path}/in")
    split = split_rows(spark, f"{path}/in", f"{path}/out")
    return split.refused.select(
        "raw_line",
        "reason",
        F.lit(split.n_lines).cast("bigint").alias("n_lines"),
        F.lit(split.n_kept).cast("bigint").alias("n_kept"),
    )


def _labelled(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("Amount"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("Class"),
    )


def q_scenario_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = assign_scenario(_labelled(table(spark, sf_dir, "events")), "event_id")
    return drawn.select("event_id", "Class", "scenario", "User_ID")


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(_labelled(table(spark, sf_dir, "events")), "event_id")


def q_burst_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir).select(
        "Transaction_ID", "User_ID", "Timestamp", "Amount", "Class", "Bot_Sequence"
    )


def q_scenario_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(_feed(spark, sf_dir))


def q_envelope_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as keyed messages in a log, read back and taken apart."""
    log = MessageSource(format="parquet", path=run_folder(spark, "envelope"))
    write_messages(envelope(_feed(spark, sf_dir)), log)
    return _taken_apart(scan_messages(spark, log))


def _taken_apart(messages: DataFrame) -> DataFrame:
    value = F.col("value").cast("string")
    fields = ["Transaction_ID", "User_ID", "Timestamp", "Amount", "Class"]
    taken_apart = messages.select(
        F.col("key").cast("string").alias("message_key"),
        value.contains("Bot_Sequence").alias("in_burst"),
        F.json_tuple(value, *fields).alias(*fields),
    )
    return taken_apart.withColumns(
        {"Amount": F.col("Amount").cast("double"), "Class": F.col("Class").cast("int")}
    )


def q_message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 35 fields of a message, made of the events and decoded again. Some are left out, some
    are null, some are of another type, by event type."""
    events = table(spark, sf_dir, "events")
    transactions = transactions_from_events(events)
    number = F.regexp_extract("Transaction_ID", r"(\d+)$", 1).cast("bigint")
    kind = F.pmod(number, F.lit(5))
    components = {
        name: F.when(kind != k % 5, F.round(number * F.lit(k) / 4, 2))
        for k, name in enumerate(COMPONENTS, 1)
    }
    record = transactions.select(
        "Transaction_ID",
        "User_ID",
        iso_text(F.col("event_time")).alias("Timestamp"),
        F.when(kind == 1, F.lit("soon")).otherwise(number.cast("string")).alias("Time_text"),
        number.cast("double").alias("Time"),
        "Amount",
        "Class",
        F.when(kind == 2, kind.cast("int")).alias("Bot_Sequence"),
        *(column.alias(name) for name, column in components.items()),
    )
    sent = F.struct(*(F.col(c) for c in MESSAGE.names))
    text = F.to_json(sent)
    # A text where a number belongs, as another sender might have it.
    text = F.when(
        F.col("Time_text") == "soon", F.regexp_replace(text, r'"Time":[^,]*', '"Time":"soon"')
    ).otherwise(text)
    return decode_json(record.select(text.cast("binary").alias("value")))


# -- streams ----------------------------------------------------------------------------


class _Replay:
    """The events as a message log that grows slice by slice, and the stored blacklist."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, name: str, state_partitions: int | None = None
    ) -> None:
        # Each slice is drained by a query of its own, and a change log would be applied again by
        # every one of them: work that grows with the square of the slices.
        self.spark = stateful_session(spark, state_partitions, change_log=False)
        self.folder = run_folder(spark, name)
        self.events = table(self.spark, sf_dir, "events")
        self.log = MessageSource(format="parquet", path=f"{self.folder}/messages")
        self._blacklist = blacklist_from_accounts(
            table(self.spark, sf_dir, "customer"), table(self.spark, sf_dir, "supplier")
        )

    def publish(self, events: DataFrame) -> None:
        write_messages(messages_from_events(events), self.log)

    def messages(self, bounded: bool = False) -> DataFrame:
        """``bounded`` cuts the log into batches by size, in file order: for queries that
        do not mind which messages share a batch."""
        options = {"maxBytesPerTrigger": str(BATCH_BYTES)} if bounded else {}
        return read_messages(self.spark, replace(self.log, options=options))

    def outputs(self, bounded: bool = False) -> Detection:
        path = f"{self.folder}/blacklist"
        store_blacklist(self._blacklist, path)
        blacklist = read_blacklist(self.spark, path)
        return detect_messages(
            self.messages(bounded), blacklist, EVENTS_CONFIG, already_unique=True
        )

    def job(self, output: DataFrame, mode: str, sink, every: str | None = None) -> StreamJob:
        return StreamJob("replay", output, mode, sink, f"{self.folder}/checkpoint", every)

    def stored(self, spark: SparkSession, output: DataFrame, *partition_by: str) -> DataFrame:
        """The stateless ``output`` run to its end into files, as a table of ``spark``."""
        path = f"{self.folder}/output"
        self.job(output, "append", files(path, partition_by)).drain()
        return spark.read.schema(output.schema).parquet(path)


def _stateless(name: str, pick: Callable[[Detection], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        replay = _Replay(spark, sf_dir, name)
        replay.publish(replay.events)
        return replay.stored(spark, pick(replay.outputs(bounded=True)))

    return query


def q_stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = _Replay(spark, sf_dir, "stream_decode")
    replay.publish(replay.events)
    decoded = with_event_time(decode_json(replay.messages(bounded=True)))
    columns = [*DETECTION_FIELDS, "event_time"]
    return replay.stored(spark, decoded.select(*columns))


def q_stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight from the files of the table, without a message log in between."""
    replay = _Replay(spark, sf_dir, "stream_enrich")
    transactions = transactions_from_events(table_stream(replay.spark, sf_dir, "events"))
    blacklist = _blacklist(replay.spark, sf_dir)
    enriched = enrich(transactions, blacklist, EVENTS_CONFIG)
    return replay.stored(spark, enriched)


def q_stream_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stateless outputs from one scan: files split by route."""
    replay = _Replay(spark, sf_dir, "stream_routes")
    transactions = transactions_from_events(table_stream(replay.spark, sf_dir, "events"))
    enriched = enrich(transactions, _blacklist(replay.spark, sf_dir), EVENTS_CONFIG)
    routed = with_route(enriched, EVENTS_CONFIG).select("Transaction_ID", "Amount", "Route")
    return _rounded(
        replay.stored(spark, routed, "Route")
        .groupBy("Route")
        .agg(F.count("*").alias("transactions"), F.sum("Amount").alias("total_amount"))
    )


def q_stream_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as a stream of keyed messages, sent on into a log."""
    replay = _Replay(spark, sf_dir, "stream_feed")
    events = table_stream(replay.spark, sf_dir, "events")
    sent = envelope(feed(_labelled(events), "event_id"))
    replay.job(sent, "append", messages_sink(replay.log)).drain()
    return _taken_apart(scan_messages(spark, replay.log))


def _drain_slices(
    replay: _Replay, output: DataFrame, path: str, tasks: int | None = None
) -> None:
    for part in time_slices(replay.events, "ts", REPLAY_SLICES):
        replay.publish(part)
        replay.job(output, "update", change_log(path, tasks)).drain()


def _empty_log(replay: _Replay) -> None:
    """A stream source must exist before its first messages."""
    replay.publish(replay.events.limit(0))


def q_stream_bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = _Replay(spark, sf_dir, "stream_bots")
    _empty_log(replay)
    path = f"{replay.folder}/changes"
    alerts = bot_detection(decode_for_detection(replay.messages()), EVENTS_CONFIG)
    _drain_slices(replay, alerts, path)
    return _rounded(latest(spark, path, _BOT_KEYS))


def q_stream_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = _Replay(spark, sf_dir, "stream_summary")
    _empty_log(replay)
    path = f"{replay.folder}/changes"
    _drain_slices(replay, flat_window(replay.outputs().summary_statistics), path, 1)
    return latest(spark, path, _SUMMARY_KEYS)


def q_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary stream, stopped while it runs on its trigger and started again: state and
    stored changes go on from the checkpoint."""
    replay = _Replay(spark, sf_dir, "stream_restart")
    _empty_log(replay)
    path = f"{replay.folder}/changes"
    output = flat_window(replay.outputs().summary_statistics)
    first, second = time_slices(replay.events, "ts", 2)
    replay.publish(first)
    running = replay.job(output, "update", change_log(path, 1), "0 seconds").start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    replay.publish(second)
    replay.job(output, "update", change_log(path, 1)).drain()
    return latest(spark, path, _SUMMARY_KEYS)


def q_stream_bots_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The burst stream, its change log compacted every other batch and cleaned up at the end."""
    replay = _Replay(spark, sf_dir, "stream_bots_compacted")
    _empty_log(replay)
    path = f"{replay.folder}/changes"
    alerts = bot_detection(decode_for_detection(replay.messages()), EVENTS_CONFIG)
    for part in time_slices(replay.events, "ts", REPLAY_SLICES):
        replay.publish(part)
        sink = change_log(path, compaction=Compaction(_BOT_KEYS, every=2))
        replay.job(alerts, "update", sink).drain()
    vacuum(spark, path)
    return _rounded(latest(spark, path, _BOT_KEYS))


def q_stream_blacklist_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both stateless outputs while the blacklist is replaced between two slices: customers only
    for the first, suppliers too for the second."""
    replay = _Replay(spark, sf_dir, "stream_blacklist_change")
    _empty_log(replay)
    listed, path = f"{replay.folder}/blacklist", f"{replay.folder}/routed"
    customers, suppliers = (table(replay.spark, sf_dir, n) for n in ("customer", "supplier"))
    lists = [
        blacklist_from_accounts(customers, suppliers.limit(0)),
        blacklist_from_accounts(customers, suppliers),
    ]
    for part, blacklist in zip(time_slices(replay.events, "ts", 2), lists):
        store_blacklist(blacklist, listed)
        replay.publish(part)
        job = refreshed_routes(
            replay.messages(), listed, path, replay.folder, EVENTS_CONFIG, live=False
        )
        job.drain()
    return spark.read.parquet(path).select(
        "Transaction_ID", "User_ID", "User_Status", "Block_Reason", "Alert_Type", "Route"
    )


def q_stream_summary_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of closed windows, each given once: panes and windows as chained state."""
    replay = _Replay(spark, sf_dir, "stream_summary_append")
    _empty_log(replay)
    path = f"{replay.folder}/output"
    store_blacklist(replay._blacklist, f"{replay.folder}/blacklist")
    blacklist = read_blacklist(replay.spark, f"{replay.folder}/blacklist")
    transactions = decode_for_detection(replay.messages())
    enriched = enrich(transactions, blacklist, EVENTS_CONFIG, already_unique=True)
    output = flat_window(closed_summary(enriched, EVENTS_CONFIG))
    for part in time_slices(replay.events, "ts", REPLAY_SLICES):
        replay.publish(part)
        replay.job(output, "append", files(path)).drain()
    return spark.read.schema(output.schema).parquet(path)


def q_stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the burst stream still holds when it has read everything: counts of open windows,
    from its checkpoint."""
    replay = _Replay(spark, sf_dir, "stream_state")
    _empty_log(replay)
    alerts = bot_detection(decode_for_detection(replay.messages()), EVENTS_CONFIG)
    _drain_slices(replay, alerts, f"{replay.folder}/changes")
    measures = {"count": "transaction_count", "sum": "total_amount"}
    return _rounded(open_windows(spark, f"{replay.folder}/checkpoint", measures))


def q_stream_deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in which every message was sent twice, by two runs, read as each once."""
    replay = _Replay(spark, sf_dir, "stream_deduplicated")
    _empty_log(replay)
    path = f"{replay.folder}/output"
    output = deduplicated(decode_for_detection(replay.messages()), timedelta(days=1))
    for i, part in enumerate(time_slices(replay.events, "ts", REPLAY_SLICES)):
        for run in (f"{i}-first", f"{i}-again"):
            write_run(messages_from_events(part), replay.log, run)
        replay.job(output, "append", files(path)).drain()
    return spark.read.schema(output.schema).parquet(path)


def _late_last(replay: _Replay) -> Iterator[DataFrame]:
    """All events but those of one type, earliest first, and those at the end."""
    is_late = F.col("event_type") == LATE_TYPE
    yield from time_slices(replay.events.filter(~is_late), "ts", 2)
    yield replay.events.filter(is_late)


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events that come after their windows were closed, once per window."""
    replay = _Replay(spark, sf_dir, "stream_late_rows")
    _empty_log(replay)
    path, window = f"{replay.folder}/split", LATE_CONFIG.bot_window
    output = decode_for_detection(replay.messages())
    for part in _late_last(replay):
        replay.publish(part)
        sink = late_and_counted(path, window, ["User_ID"], "Amount")
        replay.job(output, "append", sink).drain()
    return flat_window(
        late_rows(spark, path).select("window", "Transaction_ID", "User_ID", "event_time")
    )


def q_stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event type arrives after all the others: of its events, those in windows that
    the watermark has closed by then are dropped and the rest still count."""
    replay = _Replay(spark, sf_dir, "stream_late_drop")
    _empty_log(replay)
    path = f"{replay.folder}/changes"
    output = bot_detection(decode_for_detection(replay.messages()), LATE_CONFIG)
    for part in _late_last(replay):
        replay.publish(part)
        replay.job(output, "update", change_log(path)).drain()
    return _rounded(latest(spark, path, _BOT_KEYS))


QUERIES: dict[str, Query] = {
    "categorize": q_categorize,
    "blacklist_scan": q_blacklist_scan,
    "blacklist_join": q_blacklist_join,
    "blacklist_join_salted": q_blacklist_join_salted,
    "blacklist_join_filtered": q_blacklist_join_filtered,
    "normal_transactions": q_normal_transactions,
    "fraud_alerts": q_fraud_alerts,
    "unrouted": q_unrouted,
    "route_totals": q_route_totals,
    "bot_detection": q_bot_detection,
    "bot_sample_category": q_bot_sample_category,
    "summary_statistics": q_summary_statistics,
    "json_decode": q_json_decode,
    "message_decode": q_message_decode,
    "message_fields": q_message_fields,
    "event_time": q_event_time,
    "csv_normalize": q_csv_normalize,
    "csv_scan": q_csv_scan,
    "csv_layouts": q_csv_layouts,
    "csv_quarantine": q_csv_quarantine,
    "scenario_assign": q_scenario_assign,
    "burst_explode": q_burst_explode,
    "scenario_totals": q_scenario_totals,
    "envelope_json": q_envelope_json,
    "stream_decode": q_stream_decode,
    "stream_enrich": q_stream_enrich,
    "stream_normal": _stateless("stream_normal", lambda d: d.normal_transactions),
    "stream_fraud": _stateless("stream_fraud", lambda d: d.fraud_alerts),
    "stream_routes": q_stream_routes,
    "stream_feed": q_stream_feed,
    "stream_bots": q_stream_bots,
    "stream_summary": q_stream_summary,
    "stream_bots_compacted": q_stream_bots_compacted,
    "stream_blacklist_change": q_stream_blacklist_change,
    "stream_restart": q_stream_restart,
    "stream_late_drop": q_stream_late_drop,
    "stream_late_rows": q_stream_late_rows,
    "stream_summary_append": q_stream_summary_append,
    "stream_state": q_stream_state,
    "stream_deduplicated": q_stream_deduplicated,
}


def in_utc(query: Query) -> Query:
    """Pin the session zone, in which zone-less timestamps are read, and return zone-less
    timestamps."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        zone = "spark.sql.session.timeZone"
        spark.conf.set(zone, SETTINGS[zone])
        return without_zone(query(spark, sf_dir))

    return run


def registered() -> dict[str, Query]:
    return {name: in_utc(query) for name, query in QUERIES.items()}
