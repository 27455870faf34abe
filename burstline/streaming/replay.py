"""Publishing a stored table as a message log, earliest rows first."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def time_slices(rows: DataFrame, time: str, count: int) -> Iterator[DataFrame]:
    """``rows`` cut into ``count`` equal spans of the zone-less column ``time``.

    A file stream orders by file age, not by content, so a replay under a watermark must
    publish early rows before late ones. The cuts are literals that reach the scan. A table
    without times is one slice.
    """
    low, high = rows.agg(F.min(time), F.max(time)).first()
    if low is None:
        yield rows
        return
    cuts = [low + (high - low) * i / count for i in range(1, count)]
    literals = [F.expr(f"TIMESTAMP_NTZ '{cut.isoformat(sep=' ')}'") for cut in cuts]
    for i in range(count):
        part = rows
        if i > 0:
            part = part.filter(F.col(time) >= literals[i - 1])
        if i < count - 1:
            part = part.filter(F.col(time) < literals[i])
        yield part
