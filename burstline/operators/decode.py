"""From message bytes to typed transactions."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from burstline.config import interval_text
from burstline.schemas import DETECTION_FIELDS, MESSAGE, narrowed


def decode_json(messages: DataFrame, schema: StructType = MESSAGE) -> DataFrame:
    """Parse the ``value`` bytes as JSON and flatten the fields.

    Fields outside the schema are ignored and missing or mistyped ones are NULL. Text
    that is no JSON object gives a row of NULLs. Pass a narrow schema where few fields
    are needed: the parser builds every declared one.

    ``inline`` rather than ``data.*``: later filters on the fields would be pushed into
    the projection, each with a parse of its own, but not below a generator.
    """
    document = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.inline(F.array(document)))


def with_event_time(transactions: DataFrame) -> DataFrame:
    """Add ``event_time`` from the ISO text; unreadable text is NULL, never an error."""
    return transactions.withColumn("event_time", F.try_to_timestamp(F.col("Timestamp")))


def decode_for_detection(messages: DataFrame) -> DataFrame:
    """The few fields that detection reads, with event time."""
    return with_event_time(decode_json(messages, narrowed(MESSAGE, DETECTION_FIELDS)))


def deduplicated(transactions: DataFrame, within: timedelta) -> DataFrame:
    """Each ``Transaction_ID`` once, for messages that were sent more than once.

    In a stream a repetition is known for as long after the first one as ``within`` says, by
    event time, and state is kept no longer. Rows without an id or a time cannot be told apart
    and all stay.
    """
    number, time = F.col("Transaction_ID"), F.col("event_time")
    known = number.isNotNull() & time.isNotNull()
    if not transactions.isStreaming:
        once = transactions.filter(known).dropDuplicates(["Transaction_ID"])
    else:
        marked = transactions.filter(known).withWatermark("event_time", interval_text(within))
        once = marked.dropDuplicatesWithinWatermark(["Transaction_ID"])
    return once.union(transactions.filter(~known))
