"""Command line jobs: store the blacklist, feed messages, detect.

    python -m burstline.app blacklist --path DIR
    python -m burstline.app feed --dataset CSV [--to DIR]
    python -m burstline.app detect --blacklist DIR --root DIR [--from DIR] [--sink ...]

Without ``--to`` / ``--from`` messages go to and come from Kafka, at the servers and topic
that ``KAFKA_BOOTSTRAP_SERVERS`` and ``KAFKA_TOPIC`` name; the connector has to be on the
class path. ``--option`` passes source settings on, such as ``minPartitions=2000`` to read a
topic with more tasks than it has partitions, or ``maxOffsetsPerTrigger``. ``--root`` holds checkpoints and outputs and must be shared by all executors.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Observation, SparkSession

from burstline.config import DetectionConfig, FeedConfig, MessageSource, dataset_path
from burstline.operators.decode import decode_for_detection
from burstline.operators.feed import envelope, total_measures
from burstline.plans.detection import (
    FOLDED,
    OUTPUTS,
    Detection,
    decode_job,
    detect,
    detection_jobs,
    read_decoded,
    refreshed_routes,
)
from burstline.plans.feeding import feed_from_csv
from burstline.session import build_session
from burstline.sources.blacklist import (
    read_blacklist,
    require_unique,
    store_initial_blacklist,
)
from burstline.sources.messages import read_messages, write_messages
from burstline.streaming.runner import start_all, supervise
from burstline.streaming.sinks import Sink, change_log, console, files

_log = logging.getLogger(__name__)


def message_source(path: str | None, settings: Sequence[str] = ()) -> MessageSource:
    """Messages at ``path``, or in Kafka; ``settings`` are ``key=value`` source options."""
    options = dict(setting.split("=", 1) for setting in settings)
    if path is None:
        return replace(MessageSource.from_env(), options=options)
    return MessageSource("parquet", path=path, options=options)


def output_sink(name: str, kind: str, root: str) -> Sink:
    mode, _, shown = {**OUTPUTS, **FOLDED}[name]
    if kind == "console":
        return console(rows=shown)
    path = f"{root}/outputs/{name}"
    if mode == "update":
        return change_log(path, tasks=1 if name == "summary_statistics" else None)
    return files(path, ["Route"] if name in FOLDED else [])


def run_feed(
    spark: SparkSession,
    dataset: str,
    target: MessageSource,
    strict: bool = True,
    config: FeedConfig = FeedConfig(),
    multi_line: bool = False,
    quarantine: str | None = None,
) -> dict[str, int]:
    """Send a labelled CSV and return the run totals, which are taken while writing."""
    transactions = feed_from_csv(
        spark, dataset, strict=strict, config=config, multi_line=multi_line, quarantine=quarantine
    )
    sent = Observation("feed_totals")
    write_messages(envelope(transactions.observe(sent, *total_measures(config))), target)
    _log.info("feed totals: %s", sent.get)
    return sent.get


def run_detection(
    spark: SparkSession,
    source: MessageSource,
    blacklist_path: str,
    root: str,
    sink: str = "console",
    live: bool = True,
    fold_routes: bool = False,
    decode_once: bool = False,
    salt_buckets: int = 1,
    bloom_words: int = 0,
    refresh_blacklist: bool = False,
    config: DetectionConfig = DetectionConfig(),
) -> None:
    """Run the detection queries until they end, one fails or the job is interrupted.

    Stateful queries keep as many state partitions as ``spark`` has shuffle partitions; the
    number is frozen by the first run on ``root``. The blacklist must have one row per user.
    Without ``live`` a topic is read from its beginning to its end. ``decode_once`` puts a
    typed table under ``root`` between the messages and the queries. ``refresh_blacklist``
    writes the two stateless outputs as one table, by the list that is current for each batch.
    """
    if refresh_blacklist and sink != "tables":
        raise ValueError("the blacklist is looked up per batch for tables only")
    if not live:
        source = source.from_beginning()
    require_unique(read_blacklist(spark, blacklist_path))
    decoded = f"{root}/outputs/decoded_transactions"
    decoding = decode_job(read_messages(spark, source), decoded, root, live)

    def outputs_in(session: SparkSession) -> Detection:
        if decode_once:
            transactions = read_decoded(session, decoded)
        else:
            transactions = decode_for_detection(read_messages(session, source))
        blacklist = read_blacklist(session, blacklist_path)
        return detect(transactions, blacklist, config, True, salt_buckets, bloom_words)

    jobs = detection_jobs(
        outputs_in(spark), root, lambda name: output_sink(name, sink, root), live, fold_routes
    )
    if refresh_blacklist:
        folded = next(iter(FOLDED))
        routes = refreshed_routes(
            read_messages(spark, source),
            blacklist_path,
            f"{root}/outputs/{folded}",
            root,
            config,
            live,
        )
        jobs = [routes, *(job for job in jobs if job.mode == "update")]
    if decode_once and live:
        jobs = [decoding, *jobs]
    elif decode_once:
        decoding.drain()
    supervise(start_all(jobs))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="burstline")
    jobs = parser.add_subparsers(dest="job", required=True)
    blacklist = jobs.add_parser("blacklist", help="store the initial blacklist")
    blacklist.add_argument("--path", required=True)
    blacklist.add_argument("--replace", action="store_true", help="overwrite a stored list")
    feed = jobs.add_parser("feed", help="turn a labelled CSV into messages")
    feed.add_argument("--dataset", default=None)
    feed.add_argument("--to", default=None)
    feed.add_argument("--lenient", action="store_true", help="set unreadable lines aside")
    feed.add_argument("--quarantine", default=None, help="new folder for lines set aside")
    feed.add_argument("--multi-line", action="store_true", help="line breaks inside quotes")
    detection = jobs.add_parser("detect", help="run the detection queries")
    detection.add_argument("--blacklist", required=True)
    detection.add_argument("--root", required=True)
    detection.add_argument("--from", dest="source", default=None)
    detection.add_argument("--sink", choices=["console", "tables"], default="console")
    detection.add_argument("--drain", action="store_true", help="stop at the end of the data")
    detection.add_argument("--fold-routes", action="store_true")
    detection.add_argument("--decode-once", action="store_true")
    detection.add_argument("--salt-buckets", type=int, default=1)
    detection.add_argument(
        "--refresh-blacklist", action="store_true", help="look the list up for every batch"
    )
    detection.add_argument(
        "--bloom-words", type=int, default=0, help="filter of so many words before a large list"
    )
    for job in (feed, detection):
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO)
    options = _parser().parse_args(arguments)
    spark = build_session()
    if options.job == "blacklist":
        store_initial_blacklist(spark, options.path, options.replace)
    elif options.job == "feed":
        dataset = options.dataset or dataset_path()
        target = message_source(options.to, options.option)
        run_feed(
            spark,
            dataset,
            target,
            strict=not options.lenient,
            multi_line=options.multi_line,
            quarantine=options.quarantine,
        )
    else:
        try:
            run_detection(
                spark,
                message_source(options.source, options.option),
                options.blacklist,
                options.root,
                options.sink,
                not options.drain,
                options.fold_routes,
                options.decode_once,
                options.salt_buckets,
                options.bloom_words,
                options.refresh_blacklist,
            )
        except KeyboardInterrupt:
            _log.info("interrupted; queries stopped")


if __name__ == "__main__":
    main()
