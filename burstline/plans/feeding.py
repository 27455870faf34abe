"""The feed job: source rows in, keyed JSON messages out."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.config import FeedConfig
from burstline.operators.feed import assign_scenario, normalize, replicate_bursts, stamp
from burstline.sources.csv_rows import ROW_KEY, read_csv_rows
from burstline.sources.quarantine import split_rows
from burstline.streaming.workspace import run_folder

_log = logging.getLogger(__name__)

# Years 1 to 9999 in seconds.
FIRST_SECOND, END_SECOND = -62135596800.0, 253402300800.0


def feed(
    rows: DataFrame, key: str, time: str = "event_time", config: FeedConfig = FeedConfig()
) -> DataFrame:
    """Transactions ready for the envelope, from typed rows with a key and a time."""
    label = "Class" if "Class" in rows.columns else None
    drawn = assign_scenario(rows, key, label, config)
    return stamp(replicate_bursts(drawn, time, config), key, time)


def feed_from_csv(
    spark: SparkSession,
    path: str,
    start: Column | None = None,
    strict: bool = True,
    config: FeedConfig = FeedConfig(),
    multi_line: bool = False,
    quarantine: str | None = None,
) -> DataFrame:
    """The feed of a labelled CSV. Row times are ``start`` (the time of the run unless
    given) plus the row's own ``Time`` in seconds. Without ``strict``, lines that cannot be
    read go to ``quarantine``, a new folder of :func:`split_rows`, by default one below the
    shared folder; it is named in the log, with counts. A ``Time`` outside the years 1 to 9999 fails the job, or
    without ``strict`` gives a NULL time; the metric ``feed_times`` counts those rows.
    ``multi_line`` reads line breaks inside quotes."""
    if not strict and multi_line:
        raise ValueError("lines that are refused one by one cannot hold line breaks")
    if strict:
        found = read_csv_rows(spark, path, multi_line=multi_line)
    else:
        out = quarantine or run_folder(spark, "quarantine")
        split = split_rows(spark, path, out)
        _log.info(
            "%s lines: %s kept, %s refused, see %s",
            split.n_lines, split.n_kept, split.n_refused, out,
        )
        found = split.kept
    columns = [name for name in found.columns if name != ROW_KEY]
    rows = normalize(found, columns)
    begin = F.current_timestamp() if start is None else start
    if "Time" in columns:
        total = F.unix_micros(begin) / 1e6 + F.col("Time")
        inside = (total >= FIRST_SECOND) & (total < END_SECOND)
        rows = rows.observe("feed_times", F.count_if(~inside).alias("outside"))
        seconds = F.when(inside, F.col("Time"))
        micros = F.unix_micros(begin) + F.round(seconds * 1e6).cast("bigint")
        refused = F.raise_error(F.lit("a Time outside the years 1 to 9999")).cast("timestamp")
        outside = refused if strict else F.lit(None).cast("timestamp")
        begin = F.when(inside, F.timestamp_micros(micros)).otherwise(outside)
    return feed(rows.withColumn("event_time", begin), ROW_KEY, "event_time", config)
