"""The state of a finished or stopped query as a table, read from its checkpoint.

It tells what is still open: groups whose windows the watermark has not closed, with their counts
so far. The query need not run, and nothing of it is changed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query: number, name, partitions, first and last batch."""
    return spark.read.format("state-metadata").load(checkpoint)


def open_windows(
    spark: SparkSession,
    checkpoint: str,
    measures: Mapping[str, str],
    operator: int = 0,
    batch: int | None = None,
) -> DataFrame:
    """Windowed groups in the state: ``window_start``, ``window_end``, the other keys, and the
    values named in ``measures`` (name in the state -> column), as of the last committed batch or
    the given one."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    keys = [name for name in state.schema["key"].dataType.names if name != "window"]
    return state.select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        *(F.col(f"key.`{name}`").alias(name) for name in keys),
        *(F.col(f"value.`{name}`").alias(column) for name, column in measures.items()),
    )
