"""Keyed messages: ``key`` and ``value``, both binary, as a Kafka topic holds them.

A directory of Parquet files with the same two columns, or of JSON text lines, can stand
in for the topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from burstline.config import MessageSource

_KEYED = StructType([StructField("key", BinaryType()), StructField("value", BinaryType())])
_LINES = StructType([StructField("value", StringType())])


def _with_source(reader, source: MessageSource) -> DataFrame:
    reader = reader.format(source.format).options(**source.read_options())
    if source.format == "kafka":
        return reader.load().select("key", "value")
    # Runs that can be written again have folders of their own below the path.
    reader = reader.option("recursiveFileLookup", True)
    if source.format == "text":
        lines = reader.schema(_LINES).load(source.path)
        return lines.select(
            F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
        )
    return reader.schema(_KEYED).load(source.path).select("key", "value")


def read_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """Messages as an unbounded stream."""
    return _with_source(spark.readStream, source)


def scan_messages(spark: SparkSession, source: MessageSource) -> DataFrame:
    """Messages present now, as a batch."""
    return _with_source(spark.read, source.from_beginning())


def write_messages(messages: DataFrame, target: MessageSource) -> None:
    """Append a batch of messages; the key decides the partition of a Kafka topic."""
    writer = messages.select("key", "value").write.format(target.format)
    writer = writer.options(**target.write_options()).mode("append")
    if target.format == "kafka":
        writer.save()
    else:
        writer.save(target.path)


def write_run(messages: DataFrame, target: MessageSource, run: str) -> None:
    """A batch of messages that can be written again: in a folder of its own, named by ``run``,
    which a second try replaces whole. What was stored is marked by Spark's ``_SUCCESS``.

    A topic cannot take messages back, so there a second try sends them again, and so does one
    for a stream that has read the first: readers use ``deduplicated``.
    """
    if target.format == "kafka":
        write_messages(messages, target)
        return
    if not run or "/" in run or run.startswith(("_", ".")):
        raise ValueError(f"no name for a folder: {run!r}")
    writer = messages.select("key", "value").write.format(target.format)
    writer.options(**target.write_options()).mode("overwrite").save(f"{target.path}/run-{run}")
