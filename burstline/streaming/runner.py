"""Starting, bounding and supervising streaming queries."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from burstline.streaming.sinks import Sink

_POLL_SECONDS = 0.5


@dataclass(frozen=True)
class StreamJob:
    """One named query. ``every`` is the trigger interval; None drains what is there and
    stops."""

    name: str
    output: DataFrame
    mode: str
    sink: Sink
    checkpoint: str
    every: str | None = None

    def start(self) -> StreamingQuery:
        writer = (
            self.output.writeStream.queryName(self.name)
            .outputMode(self.mode)
            .option("checkpointLocation", self.checkpoint)
        )
        if self.every is None:
            writer = writer.trigger(availableNow=True)
        else:
            writer = writer.trigger(processingTime=self.every)
        return self.sink(writer).start()

    def drain(self) -> StreamingQuery:
        """Run to the end of the available data; raises if the query fails."""
        query = self.start()
        query.awaitTermination()
        return query


def start_all(jobs: Sequence[StreamJob]) -> list[StreamingQuery]:
    """Start every job; if one cannot start, stop those already running."""
    started: list[StreamingQuery] = []
    try:
        for job in jobs:
            started.append(job.start())
    except BaseException:
        stop_all(started)
        raise
    return started


def supervise(queries: Sequence[StreamingQuery]) -> None:
    """Wait until all queries end. A failure of any one, or an interrupt, stops the rest
    and is raised. Other queries of the session do not matter.

    The wait is on this side: an interrupt in the middle of a call to the JVM would break
    the connection that stopping the queries needs.
    """
    pending = list(queries)
    try:
        while pending:
            time.sleep(_POLL_SECONDS)
            ended = [query for query in pending if not query.isActive]
            for query in ended:
                query.awaitTermination()
            pending = [query for query in pending if query not in ended]
    finally:
        stop_all(queries)


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
