"""Amount category and blacklist status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.config import DetectionConfig
from burstline.operators.prefilter import filter_words, split_likely
from burstline.sources.blacklist import unique_blacklist


def categorize(transactions: DataFrame, config: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Add ``Category``. Both comparisons are strict; a NULL amount is Normal and NaN,
    which Spark orders above every number, is Macro."""
    amount = F.col("Amount")
    return transactions.withColumn(
        "Category",
        F.when(amount > config.macro_above, "Macro")
        .when(amount < config.micro_below, "Micro")
        .otherwise("Normal"),
    )


def mark_blocked(
    transactions: DataFrame,
    blacklist: DataFrame,
    already_unique: bool = False,
    salt_buckets: int = 1,
    bloom_words: int = 0,
) -> DataFrame:
    """Left join with the blacklist and add ``User_Status``.

    A user is BLOCKED if the match states a reason; key presence alone does not count.

    Spark broadcasts the blacklist while it is small enough and else shuffles both sides,
    where AQE splits a hot user in batch jobs. Stateful streams run without AQE: for a
    blacklist beyond the broadcast size, ``salt_buckets`` spreads each user's transactions
    over that many partitions and copies each blacklist row to all of them. The copies are
    never broadcast.

    ``bloom_words``, for a list too large to broadcast of which few transactions are: a Bloom
    filter of so many words of 64 bits is broadcast instead, rows that it turns away are ACTIVE
    at once, and only the others are shuffled and joined. Some 20 bits a listed user are enough.
    The rows are read once for each of the two ways.
    """
    if not already_unique:
        # The grouping leaves rows partitioned by user, which a shuffled join would take as
        # they are, and AQE splits a hot user only where both sides were shuffled for the
        # join itself. Rebalancing the few blacklist rows makes it do so.
        blacklist = unique_blacklist(blacklist).hint("rebalance")
    if bloom_words:
        filtered = filter_words(blacklist, "User_ID", bloom_words)
        likely, others = split_likely(transactions, filtered, "User_ID", bloom_words)
        found = mark_blocked(likely, blacklist, True, salt_buckets)
        nothing = F.lit(None).cast("string")
        others = others.withColumns(
            {"Block_Reason": nothing, "Block_Date": nothing, "User_Status": F.lit("ACTIVE")}
        )
        return found.unionByName(others)
    if salt_buckets > 1:
        salt = F.pmod(F.xxhash64("Transaction_ID", "event_time", "Amount"), F.lit(salt_buckets))
        # Undecodable rows are alike in all columns; without a user they match nothing anywhere.
        anywhere = F.pmod(F.spark_partition_id().cast("bigint"), F.lit(salt_buckets))
        salt = F.when(F.col("User_ID").isNull(), anywhere).otherwise(salt)
        buckets = F.sequence(F.lit(0).cast("bigint"), F.lit(salt_buckets - 1).cast("bigint"))
        transactions = transactions.withColumn("_salt", salt)
        blacklist = blacklist.withColumn("_salt", F.explode(buckets)).hint("merge")
        joined = transactions.join(blacklist, ["User_ID", "_salt"], "left").drop("_salt")
    else:
        joined = transactions.join(blacklist, "User_ID", "left")
    return joined.withColumn(
        "User_Status",
        F.when(F.col("Block_Reason").isNotNull(), "BLOCKED").otherwise("ACTIVE"),
    )


def enrich(
    transactions: DataFrame,
    blacklist: DataFrame,
    config: DetectionConfig = DetectionConfig(),
    already_unique: bool = False,
    salt_buckets: int = 1,
    bloom_words: int = 0,
) -> DataFrame:
    return mark_blocked(
        categorize(transactions, config), blacklist, already_unique, salt_buckets, bloom_words
    )
