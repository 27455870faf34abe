"""Running totals of a feed stream, from metrics observed in each batch."""

from __future__ import annotations

import logging
import threading

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQueryListener

from burstline.config import FeedConfig
from burstline.operators.feed import total_measures

METRICS = "feed_totals"
_log = logging.getLogger(__name__)


def observe_totals(transactions: DataFrame, config: FeedConfig = FeedConfig()) -> DataFrame:
    """Attach the run totals to a stream at no extra pass over the data."""
    return transactions.observe(METRICS, *total_measures(config))


class FeedProgress(StreamingQueryListener):
    """Adds up the observed totals over batches and logs them after each one."""

    def __init__(self) -> None:
        self.totals: dict[str, int] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRICS)
        if row is None:
            return
        with self._lock:
            for name, count in row.asDict().items():
                self.totals[name] = self.totals.get(name, 0) + (count or 0)
            _log.info("feed totals: %s", self.totals)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
