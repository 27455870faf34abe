"""Windowed counts with the rows that come too late for them, from the same micro-batch.

Spark drops late rows and says how many. Here each micro-batch writes what it adds to the counts
and, beside it, every row and window that was closed already, so that nothing is lost without a
trace: what is counted and what is late add up to what came in.

The watermark of a batch is that of the batches before it: the largest event time seen, less the
lateness that the window allows. It is kept per batch, so a batch that is repeated judges its rows
as it did before, and replaces both of its outputs.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.config import SlidingWindow
from burstline.streaming.compaction import BATCH
from burstline.streaming.pointer import Folder
from burstline.streaming.sinks import Sink

_COUNTED, _LATE, _MARKS = "counted", "late", "_watermarks"


def _mark(folder: Folder, batch: int) -> int | None:
    """The largest event time, in microseconds, seen before a batch."""
    found = folder.read(f"{_MARKS}/{batch - 1}.json")
    return None if found is None else found["largest"]


def late_and_counted(path: str, window: SlidingWindow, keys: list[str], amount: str) -> Sink:
    """For a stream of rows with ``event_time``. Rows without a time are in no window.

    ``counted`` holds per batch, window and key the number of rows and their ``amount``; ``late``
    the rows themselves, once per closed window that they belong to.
    """
    delay = window.watermark.total_seconds()

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        folder = Folder(spark, path)
        before = _mark(folder, batch)
        sliding = F.window("event_time", window.size_text, window.slide_text)
        placed = rows.withColumn("window", sliding).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            end = F.unix_micros("window.end")
            is_late = F.lit(False)
            if before is not None:
                is_late = end <= F.lit(before - round(delay * 1_000_000))
            counted = placed.filter(~is_late).groupBy("window", *keys)
            counted.agg(F.count("*").alias("n"), F.sum(amount).alias("amount")).write.mode(
                "overwrite"
            ).parquet(f"{path}/{_COUNTED}/{BATCH}={batch}")
            placed.filter(is_late).write.mode("overwrite").parquet(
                f"{path}/{_LATE}/{BATCH}={batch}"
            )
            largest = placed.agg(F.unix_micros(F.max("event_time"))).first()[0]
        finally:
            placed.unpersist()
        largest = max((x for x in (before, largest) if x is not None), default=None)
        Folder(spark, f"{path}/{_MARKS}").replace(f"{batch}.json", {"largest": largest})

    return lambda writer: writer.foreachBatch(write)


def counted_windows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The counts of all batches added up: ``window``, the keys, ``n`` and ``amount``."""
    parts = spark.read.parquet(f"{path}/{_COUNTED}")
    return parts.groupBy("window", *keys).agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount")
    )


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that came too late, once per closed ``window``, with the batch they came in."""
    return spark.read.parquet(f"{path}/{_LATE}")
