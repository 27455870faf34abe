"""Outputs of streaming queries.

A sink is a function that takes the writer of a query and returns it set up. An update-mode
query emits a group again on every change, so its output is a change log and needs the
keyed sink below; appending its rows to a table would repeat groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from burstline.config import MessageSource
from burstline.streaming.compaction import BATCH, Compaction, compact, latest

__all__ = ["Sink", "change_log", "console", "files", "latest", "memory", "messages"]

Sink = Callable[[DataStreamWriter], DataStreamWriter]


def console(rows: int = 20, truncate: bool = False) -> Sink:
    """Print each batch; ``rows`` limits the display only."""
    return lambda writer: (
        writer.format("console").option("numRows", rows).option("truncate", truncate)
    )


def memory() -> Sink:
    """Driver-side table named after the query; for tests and inspection."""
    return lambda writer: writer.format("memory")


def files(path: str, partition_by: Sequence[str] = ()) -> Sink:
    """Parquet files, exactly once, for append-mode queries."""

    def attach(writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.format("parquet").option("path", path)
        return writer.partitionBy(*partition_by) if partition_by else writer

    return attach


def messages(target: MessageSource) -> Sink:
    """Keyed messages, for a stream of ``key`` and ``value``."""

    def attach(writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.format(target.format).options(**target.write_options())
        return writer.option("path", target.path) if target.path else writer

    return attach


def change_log(
    path: str,
    tasks: int | None = None,
    prepare: Callable[[DataFrame, int], DataFrame] | None = None,
    compaction: Compaction | None = None,
) -> Sink:
    """Keep every batch of changes under its batch number.

    A batch that is replayed after a failure has the same number and replaces its own
    folder, so the log holds each batch once. :func:`latest` is the upserted table.

    Each state partition writes a file unless the changes are first spread over ``tasks``;
    set it where a batch changes few groups but state is wide. ``prepare`` makes of a batch
    and its number what is stored. ``compaction`` makes a base of the log every so many batches.
    """

    def write(changes: DataFrame, batch: int) -> None:
        if prepare is not None:
            changes = prepare(changes, batch)
        if tasks is not None:
            changes = changes.repartition(tasks)
        changes.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")
        if compaction is not None and (batch + 1) % compaction.every == 0:
            compact(changes.sparkSession, path, compaction.keys)

    return lambda writer: writer.foreachBatch(write)
