"""The given analytic tables as transactions, messages and a blacklist."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.config import DetectionConfig, SlidingWindow
from burstline.functions.identity import iso_text, user_id
from burstline.operators.feed import envelope

# The default constants give empty answers on ``events`` (a few hundred events a day, small
# amounts), so rules over it use these. Windows per event stay the same: two and three.
EVENTS_CONFIG = DetectionConfig(
    macro_above=100.0,
    micro_below=20.0,
    bot_window=SlidingWindow(timedelta(days=1), timedelta(hours=12), timedelta(hours=1)),
    bot_more_than=4,
    summary_window=SlidingWindow(timedelta(days=1), timedelta(hours=8), timedelta(hours=1)),
    users_kept_out_of_normal=("User_0007",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Files taken into one micro-batch; what a failed batch has to repeat.
BATCH_BYTES = 1 << 40


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files, in no particular order.

    A glob is given because a stream source takes a plain path as a folder, and the table
    may be one file.
    """
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def transactions_from_events(events: DataFrame) -> DataFrame:
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        F.concat(F.lit("TXN_"), F.col("event_id").cast("string")).alias("Transaction_ID"),
        user_id(F.col("user_id")).alias("User_ID"),
        F.col("value").alias("Amount"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("Class"),
        event_time.alias("event_time"),
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    transactions = transactions_from_events(events)
    return envelope(
        transactions.withColumn("Timestamp", iso_text(F.col("event_time"))),
        leave_out=("event_time",),
    )


def blacklist_from_accounts(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    """Accounts in arrears. It grows with the tables, lists some users twice (customer and
    supplier numbers overlap) and some without a reason."""

    def block_date(number: str):
        first_day = F.to_date(F.lit("2024-01-01"))
        day = F.date_add(first_day, F.pmod(F.col(number), F.lit(365)).cast("int"))
        return F.date_format(day, "yyyy-MM-dd")

    segment = F.col("c_mktsegment")
    customers = customer.filter(F.col("c_acctbal") < 0).select(
        user_id(F.col("c_custkey")).alias("User_ID"),
        F.when(segment != "BUILDING", F.concat(F.lit("Arrears "), segment)).alias("Block_Reason"),
        block_date("c_custkey").alias("Block_Date"),
    )
    suppliers = supplier.filter(F.col("s_acctbal") < 0).select(
        user_id(F.col("s_suppkey")).alias("User_ID"),
        F.lit("Supplier arrears").alias("Block_Reason"),
        block_date("s_nationkey").alias("Block_Date"),
    )
    return customers.unionByName(suppliers)


def without_zone(frame: DataFrame) -> DataFrame:
    """Timestamps as zone-less, the type the given tables use."""
    columns = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name)
        if f.dataType.typeName() == "timestamp"
        else F.col(f.name)
        for f in frame.schema.fields
    ]
    return frame.select(*columns)
