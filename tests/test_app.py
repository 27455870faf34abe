"""The command line jobs end to end, and their settings."""

import random

import pytest
from pyspark.sql import functions as F

from burstline import app, session
from burstline.config import DetectionConfig, FeedConfig, MessageSource, dataset_path
from burstline.operators.decode import decode_json
from burstline.plans.detection import (
    FOLDED,
    OUTPUTS,
    decode_job,
    detect,
    detection_jobs,
    read_decoded,
)
from burstline.schemas import DETECTION, SOURCE_COLUMNS
from burstline.session import ROCKSDB, stateful_session
from burstline.sources.blacklist import read_blacklist
from burstline.sources.messages import read_messages
from burstline.streaming import sinks
from burstline.streaming.runner import start_all, stop_all


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    path = tmp_path_factory.mktemp("data") / "rows.csv"
    draw = random.Random(7)
    lines = [",".join(SOURCE_COLUMNS)]
    for i in range(3000):
        parts = [f"{draw.gauss(0, 1):.6f}" for _ in range(28)]
        label = '"1"' if i % 100 == 0 else '"0"'
        lines.append(",".join([str(i * 2), *parts, f"{draw.expovariate(1 / 90):.2f}", label]))
    lines.insert(40, "1,2,3")
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def fed(spark, dataset, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    app.main(["blacklist", "--path", str(folder / "blacklist")])
    app.main(["feed", "--dataset", dataset, "--to", str(folder / "log")])
    return folder


def test_feed_sends_every_row(spark, fed):
    sent = decode_json(spark.read.parquet(str(fed / "log"))).cache()
    bursts = sent.filter("Bot_Sequence = 1").count()
    assert sent.filter("User_ID = 'User_Hacker'").count() == 30
    assert bursts > 0 and sent.count() == 3000 + 4 * bursts


def test_feed_returns_its_totals(spark, dataset, fed, tmp_path):
    totals = app.run_feed(spark, dataset, MessageSource("parquet", path=str(tmp_path / "log")))
    assert totals["total_sent"] == spark.read.parquet(str(fed / "log")).count()
    assert totals["fraud_count"] == 30
    assert totals["normal_count"] + totals["fraud_count"] + totals["bot_attacks"] == 3000
    assert totals["bot_transactions"] == 5 * totals["bot_attacks"]


@pytest.mark.parametrize("flags", [[], ["--fold-routes"], ["--decode-once", "--fold-routes"]])
def test_detect_writes_every_output(spark, fed, tmp_path, flags):
    root = str(tmp_path)
    arguments = ["detect", "--from", str(fed / "log"), "--blacklist", str(fed / "blacklist")]
    arguments += ["--root", root, "--sink", "tables", "--drain"]
    app.main(arguments + flags)

    def output(name):
        return spark.read.parquet(f"{root}/outputs/{name}")

    if "--fold-routes" in flags:
        routed = output("routed_transactions")
        normal, alerts = routed.filter("Route = 'normal'"), routed.filter("Route = 'alert'")
    else:
        normal, alerts = output("normal_transactions"), output("fraud_alerts")
    sent = spark.read.parquet(str(fed / "log")).count()
    burst_rows = sent - alerts.count() - normal.count()
    assert alerts.count() == 30 and burst_rows % 5 == 0 and burst_rows > 0
    assert {r.Alert_Type for r in alerts.collect()} == {"BLOCKED_USER"}
    bots = sinks.latest(
        spark,
        f"{root}/outputs/bot_detection",
        ["window_start", "window_end", "User_ID", "Alert_Status"],
    )
    assert bots.filter("User_ID = 'User_Bot'").count() > 0
    summary = sinks.latest(spark, f"{root}/outputs/summary_statistics", ["window"])
    assert summary.agg(F.sum("total_transactions")).first()[0] == 3 * sent
    uneven = "macro_count + micro_count + normal_count != total_transactions"
    assert summary.filter(uneven).count() == 0


def test_decoding_once_while_live(spark, fed, tmp_path):
    root, source = str(tmp_path), MessageSource("parquet", path=str(fed / "log"))
    decoding = decode_job(read_messages(spark, source), f"{root}/decoded", root)
    blacklist = read_blacklist(spark, str(fed / "blacklist"))
    outputs = detect(read_decoded(spark, f"{root}/decoded"), blacklist)
    jobs = detection_jobs(outputs, root, lambda name: sinks.files(f"{root}/{name}"))
    queries = start_all([decoding, jobs[1]])
    try:
        queries[0].processAllAvailable()
        queries[1].processAllAvailable()
    finally:
        stop_all(queries)
    assert spark.read.parquet(f"{root}/fraud_alerts").count() == 30
    stored = spark.read.parquet(f"{root}/decoded")
    assert stored.schema == DETECTION and stored.count() == spark.read.parquet(source.path).count()


def test_sinks_by_query():
    assert set(OUTPUTS) == {
        "normal_transactions", "fraud_alerts", "bot_detection", "summary_statistics"
    }
    assert [shown for _, _, shown in OUTPUTS.values()] == [20, 50, 30, 10]
    for name in [*OUTPUTS, *FOLDED]:
        for kind in ("console", "tables"):
            assert callable(app.output_sink(name, kind, "/root"))


def test_settings_come_from_the_environment():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "a:1,b:2", "KAFKA_TOPIC": "t", "DATASET_PATH": "/x.csv"}
    source = MessageSource.from_env(env)
    assert source.read_options() == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert source.write_options()["topic"] == "t" and source.write_options()["kafka.acks"] == "all"
    assert dataset_path(env) == "/x.csv"
    default = MessageSource.from_env({})
    assert (default.servers, default.topic) == ("localhost:9092", "bank_transactions")
    assert dataset_path({}) == "/data/creditcard.csv"


def test_defaults():
    config, feed = DetectionConfig(), FeedConfig()
    assert (config.macro_above, config.micro_below, config.bot_more_than) == (500.0, 20.0, 4)
    bot, summary = config.bot_window, config.summary_window
    assert (bot.size_text, bot.slide_text, bot.watermark_text) == (
        "10 seconds", "5 seconds", "20 seconds"
    )
    assert (summary.size_text, summary.slide_text, summary.watermark_text) == (
        "30 seconds", "10 seconds", "30 seconds"
    )
    assert (feed.burst_per_10000, feed.burst_rows, feed.pool_size) == (200, 5, 1000)


def test_source_options_of_the_command_line(monkeypatch):
    monkeypatch.delenv("KAFKA_TOPIC", raising=False)
    kafka = app.message_source(None, ["minPartitions=9", "startingOffsets=earliest"])
    assert kafka.read_options()["minPartitions"] == "9"
    assert kafka.read_options()["startingOffsets"] == "earliest"
    bounded = app.message_source(None).from_beginning().read_options()
    assert (bounded["startingOffsets"], bounded["failOnDataLoss"]) == ("earliest", "true")
    assert app.message_source("/folder").from_beginning() == app.message_source("/folder")
    assert kafka.topic == "bank_transactions"
    assert app.message_source("/log", ["a=b=c"]).read_options() == {"a": "b=c"}


def test_file_sources_take_their_own_options():
    source = MessageSource("parquet", path="/log", options={"maxFilesPerTrigger": "9"})
    assert source.read_options() == {"maxFilesPerTrigger": "9"} == source.write_options()


def test_stateful_session_has_its_own_settings(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    sibling = stateful_session(spark, 3)
    assert sibling.conf.get(key) == "3" and spark.conf.get(key) == before
    assert sibling.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    assert int(stateful_session(spark).conf.get(key)) == spark.sparkContext.defaultParallelism


@pytest.mark.parametrize(
    "master, cores, shuffle, width",
    [("local[8]", 8, 200, 8), ("yarn", 2, 200, 200), ("spark://host:7077", 4000, 200, 4000)],
)
def test_state_width_follows_the_cluster(master, cores, shuffle, width):
    context = type("Context", (), {"master": master, "defaultParallelism": cores})()
    conf = {"spark.sql.shuffle.partitions": str(shuffle)}
    cluster = type("Session", (), {"sparkContext": context, "conf": conf})()
    assert session._default_width(cluster) == width


def test_job_session(spark):
    assert session.SETTINGS["spark.sql.session.timeZone"] == "UTC"
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    built = session.build_session()
    assert int(built.conf.get(key)) == 4 * spark.sparkContext.defaultParallelism
    built.conf.unset(key)
