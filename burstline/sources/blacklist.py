"""The reference table of blocked users.

It is read from storage, never built from driver-side rows, because a stored table has a
size: Spark broadcasts it while it is below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles beyond that. Every list that is stored is a snapshot of its own, so a list can be
replaced under running queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.schemas import BLACKLIST
from burstline.sources.snapshots import Snapshots

# The blacklist that a new deployment starts with.
INITIAL_ROWS = [
    ("User_Hacker", "Known Fraud Actor", "2024-01-01"),
    ("Suspicious_User_001", "Multiple Fraud Attempts", "2024-03-15"),
    ("Blocked_Account_42", "Identity Theft", "2024-06-20"),
]


def read_blacklist(spark: SparkSession, path: str, snapshot: int | None = None) -> DataFrame:
    """The stored list, as it is now unless a snapshot is named."""
    return Snapshots(spark, path).read(BLACKLIST, snapshot)


def unique_blacklist(blacklist: DataFrame) -> DataFrame:
    """One row per user, so that a join with it cannot multiply transactions.

    Of several rows for a user the one with a reason wins, then the earliest date, then
    the alphabetically first reason. Rows without a user match nothing and are dropped.
    """
    reason, date = F.col("Block_Reason"), F.col("Block_Date")
    preference = F.struct(reason.isNull(), date.isNull(), date, reason)
    return (
        blacklist.filter(F.col("User_ID").isNotNull())
        .groupBy("User_ID")
        .agg(F.min_by(F.struct(reason, date), preference).alias("chosen"))
        .select("User_ID", "chosen.Block_Reason", "chosen.Block_Date")
    )


def store_blacklist(blacklist: DataFrame, path: str) -> int:
    """Store the unique form, so that streaming joins need not repeat the grouping. It is the
    current list from then on; returns the number of its snapshot."""
    return Snapshots(blacklist.sparkSession, path).publish(unique_blacklist(blacklist))


def require_unique(blacklist: DataFrame) -> None:
    """Fails if a user is listed twice, which would multiply transactions in a join."""
    users = F.col("User_ID")
    counts = blacklist.agg(F.count(users).alias("n"), F.count_distinct(users).alias("users"))
    n, distinct = counts.first()
    if n != distinct:
        raise ValueError(f"the blacklist has {n} rows for {distinct} users; store it again")


def store_initial_blacklist(spark: SparkSession, path: str, replace: bool = False) -> None:
    """Fails if there is a list already, unless it is to be replaced."""
    if not replace and Snapshots(spark, path).current() is not None:
        raise FileExistsError(f"a blacklist exists already in {path}")
    store_blacklist(spark.createDataFrame(INITIAL_ROWS, BLACKLIST), path)
