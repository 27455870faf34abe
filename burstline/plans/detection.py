"""The detection job: messages in, four outputs out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from burstline.config import DetectionConfig
from burstline.operators.decode import decode_for_detection
from burstline.operators.enrich import categorize, mark_blocked
from burstline.operators.route import fraud_alerts, normal_transactions, routed_transactions
from burstline.operators.windows import bot_detection, summary_statistics
from burstline.schemas import BLACKLIST, DETECTION
from burstline.sources.snapshots import Snapshots
from burstline.streaming.runner import StreamJob
from burstline.streaming.sinks import Sink, change_log, files

# Query names with output mode, trigger interval and rows shown on a console.
OUTPUTS = {
    "normal_transactions": ("append", "5 seconds", 20),
    "fraud_alerts": ("append", "3 seconds", 50),
    "bot_detection": ("update", "5 seconds", 30),
    "summary_statistics": ("update", "10 seconds", 10),
}
# In place of the first two when they are folded into one query.
FOLDED = {"routed_transactions": ("append", "3 seconds", 50)}


@dataclass(frozen=True)
class Detection:
    """The four outputs over one set of transactions, batch or streaming, and the first two
    folded into one."""

    normal_transactions: DataFrame
    fraud_alerts: DataFrame
    routed_transactions: DataFrame
    bot_detection: DataFrame
    summary_statistics: DataFrame


def detect(
    transactions: DataFrame,
    blacklist: DataFrame,
    config: DetectionConfig = DetectionConfig(),
    already_unique: bool = False,
    salt_buckets: int = 1,
    bloom_words: int = 0,
) -> Detection:
    """``transactions`` are decoded and carry ``event_time``.

    Burst detection reads no blacklist column and the blacklist has one row per user, so
    that output is built without the join.
    """
    categorized = categorize(transactions, config)
    enriched = mark_blocked(categorized, blacklist, already_unique, salt_buckets, bloom_words)
    return Detection(
        normal_transactions(enriched, config),
        fraud_alerts(enriched),
        routed_transactions(enriched, config),
        bot_detection(categorized, config),
        summary_statistics(enriched, config),
    )


def detect_messages(
    messages: DataFrame,
    blacklist: DataFrame,
    config: DetectionConfig = DetectionConfig(),
    already_unique: bool = False,
    salt_buckets: int = 1,
    bloom_words: int = 0,
) -> Detection:
    transactions = decode_for_detection(messages)
    return detect(transactions, blacklist, config, already_unique, salt_buckets, bloom_words)


def decode_job(messages: DataFrame, path: str, root: str, live: bool = True) -> StreamJob:
    """Decode each message once into a typed table that the detection queries can share.

    Without it every query parses every message for itself.
    """
    return StreamJob(
        "decoded_transactions",
        decode_for_detection(messages),
        "append",
        files(path),
        f"{root}/checkpoints/decoded_transactions",
        "3 seconds" if live else None,
    )


def read_decoded(spark: SparkSession, path: str) -> DataFrame:
    """The typed table as a stream, in the order in which its batches were stored."""
    # A stream source must exist before its first files.
    spark.createDataFrame([], DETECTION).write.mode("ignore").parquet(path)
    return spark.readStream.schema(DETECTION).parquet(path)


def refreshed_routes(
    messages: DataFrame,
    blacklist_path: str,
    path: str,
    root: str,
    config: DetectionConfig = DetectionConfig(),
    live: bool = True,
) -> StreamJob:
    """The two stateless outputs as one query that looks the blacklist up anew for every
    micro-batch, so a list that is replaced counts from the next batch on.

    The snapshot that a batch has taken is kept with the checkpoint: a batch that is repeated
    takes the same one and replaces its own rows. Stateful outputs take the list that is current
    when they start.
    """
    name = next(iter(FOLDED))
    checkpoint = f"{root}/checkpoints/{name}"

    def prepare(transactions: DataFrame, batch: int) -> DataFrame:
        blacklist = Snapshots(transactions.sparkSession, blacklist_path)
        number = blacklist.pinned(batch, f"{checkpoint}-snapshots")
        categorized = categorize(transactions, config)
        listed = blacklist.read(BLACKLIST, number)
        return routed_transactions(mark_blocked(categorized, listed, already_unique=True), config)

    return StreamJob(
        name,
        decode_for_detection(messages),
        "append",
        change_log(path, prepare=prepare),
        checkpoint,
        FOLDED[name][1] if live else None,
    )


def detection_jobs(
    outputs: Detection,
    root: str,
    sink: Callable[[str], Sink],
    live: bool = True,
    fold_routes: bool = False,
) -> list[StreamJob]:
    """The named queries, each with a checkpoint of its own under ``root``.

    They share a plan but no execution: every query reads the source for itself.
    ``fold_routes`` runs the two stateless ones as one. ``live`` queries run on their
    trigger intervals, others drain what is there.
    """
    plans = dict(OUTPUTS)
    if fold_routes:
        stateful = {name: plan for name, plan in OUTPUTS.items() if plan[0] == "update"}
        plans = {**FOLDED, **stateful}
    return [
        StreamJob(
            name,
            getattr(outputs, name),
            mode,
            sink(name),
            f"{root}/checkpoints/{name}",
            every if live else None,
        )
        for name, (mode, every, _) in plans.items()
    ]
