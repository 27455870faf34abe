"""Schemas of the source table, the message, the reference table and the outputs."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Field names of the transaction message, in order.
COMPONENTS = [f"V{i}" for i in range(1, 29)]
MESSAGE = StructType(
    [
        StructField("Transaction_ID", StringType()),
        StructField("User_ID", StringType()),
        StructField("Timestamp", StringType()),
        StructField("Time", DoubleType()),
        StructField("Amount", DoubleType()),
        StructField("Class", IntegerType()),
        StructField("Bot_Sequence", IntegerType()),
        *(StructField(name, DoubleType()) for name in COMPONENTS),
    ]
)

# Columns of the labelled source CSV, in header order.
SOURCE_COLUMNS = ["Time", *COMPONENTS, "Amount", "Class"]

# The only message fields that the four detection queries read.
DETECTION_FIELDS = ["Transaction_ID", "User_ID", "Timestamp", "Amount", "Class"]

BLACKLIST = StructType(
    [
        StructField("User_ID", StringType()),
        StructField("Block_Reason", StringType()),
        StructField("Block_Date", StringType()),
    ]
)

# Output columns of the four detection queries, in order.
NORMAL = StructType(
    [
        StructField("Transaction_ID", StringType()),
        StructField("User_ID", StringType()),
        StructField("Amount", DoubleType()),
        StructField("Category", StringType()),
        StructField("User_Status", StringType()),
        StructField("event_time", TimestampType()),
    ]
)
ALERT = StructType(
    [
        StructField("Transaction_ID", StringType()),
        StructField("User_ID", StringType()),
        StructField("Amount", DoubleType()),
        StructField("Category", StringType()),
        StructField("User_Status", StringType()),
        StructField("Block_Reason", StringType()),
        StructField("Class", IntegerType()),
        StructField("event_time", TimestampType()),
        StructField("Alert_Type", StringType()),
    ]
)
BOT = StructType(
    [
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("User_ID", StringType()),
        StructField("transaction_count", LongType()),
        StructField("total_amount", DoubleType()),
        StructField("Alert_Status", StringType()),
    ]
)
SUMMARY = StructType(
    [
        StructField(
            "window",
            StructType(
                [StructField("start", TimestampType()), StructField("end", TimestampType())]
            ),
        ),
        StructField("total_transactions", LongType()),
        StructField("macro_count", LongType()),
        StructField("micro_count", LongType()),
        StructField("normal_count", LongType()),
        StructField("blocked_count", LongType()),
        StructField("fraud_count", LongType()),
        StructField("avg_amount", DoubleType()),
        StructField("total_amount", DoubleType()),
    ]
)


def narrowed(schema: StructType, names: list[str]) -> StructType:
    """The fields of ``schema`` called ``names``; ``from_json`` parses no others."""
    return StructType([schema[name] for name in names])


# Decoded transactions as the detection queries take them.
DETECTION = StructType(
    [*narrowed(MESSAGE, DETECTION_FIELDS).fields, StructField("event_time", TimestampType())]
)
