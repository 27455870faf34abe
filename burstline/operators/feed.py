"""Feed preparation: source rows to keyed JSON messages, with fraud and burst scenarios.

Draws come from a hash of a stable row key instead of a random generator, and times from
the data instead of the clock, so a retried task or a repeated run gives the same feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from burstline.config import FeedConfig, interval_text
from burstline.functions.coerce import (
    is_bad_label,
    lenient_double,
    lenient_label,
    routing_label,
    strict_label,
)
from burstline.functions.identity import (
    digest_bucket,
    iso_text,
    key_digest,
    transaction_id,
    user_id,
)

FRAUD, BURST, NORMAL = "fraud", "burst", "normal"


def _is_number(name: str) -> bool:
    return name in ("Time", "Amount") or name.startswith("V")


def normalize(rows: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Type the text ``columns`` by name; any other column passes through.

    Time, Amount and names with a leading V become doubles (unreadable: 0.0), Class an
    int, all else stays text. ``strict`` fails the job on an unreadable Class; otherwise
    it is NULL and ``bad_label`` tells those rows apart.
    """
    typed: list[Column] = []
    for name in rows.columns:
        text = F.col(f"`{name}`")
        if name not in columns:
            typed.append(text)
        elif _is_number(name):
            typed.append(lenient_double(text).alias(name))
        elif name == "Class":
            typed.append((strict_label(text) if strict else lenient_label(text)).alias(name))
        else:
            typed.append(F.coalesce(text, F.lit("")).alias(name))
    if not strict and "Class" in columns:
        typed.append(is_bad_label(F.col("Class")).alias("bad_label"))
    return rows.select(*typed)


def assign_scenario(
    rows: DataFrame, key: str, label: str | None = "Class", config: FeedConfig = FeedConfig()
) -> DataFrame:
    """Add ``scenario`` and ``User_ID``.

    Label 1 is fraud; of the others a fixed share starts a burst and the rest get a user
    from the pool. ``label`` may be typed or still text.
    """
    is_fraud = F.lit(False)
    if label is not None:
        is_text = isinstance(rows.schema[label].dataType, StringType)
        number = routing_label(F.col(label)) if is_text else F.col(label)
        is_fraud = F.coalesce(number == 1, F.lit(False))
    digest = F.col("_digest")
    drawn = rows.withColumn("_digest", key_digest(F.col(key)))
    is_burst = digest_bucket(digest, 0, 10_000) < config.burst_per_10000
    pool_user = user_id(digest_bucket(digest, 1, config.pool_size) + 1)
    scenario = F.col("scenario")
    return (
        drawn.withColumn(
            "scenario", F.when(is_fraud, FRAUD).when(is_burst, BURST).otherwise(NORMAL)
        )
        .withColumn(
            "User_ID",
            F.when(scenario == FRAUD, config.fraud_user)
            .when(scenario == BURST, config.bot_user)
            .otherwise(pool_user),
        )
        .drop("_digest")
    )


def replicate_bursts(
    rows: DataFrame, time: str = "event_time", config: FeedConfig = FeedConfig()
) -> DataFrame:
    """Repeat burst rows a few milliseconds apart and number them in ``Bot_Sequence``.

    Other rows pass once, with a NULL number. ``time`` is advanced per repeat.
    """
    burst = F.sequence(F.lit(1), F.lit(config.burst_rows))
    once = F.array(F.lit(None).cast("int"))
    copies = F.when(F.col("scenario") == BURST, burst).otherwise(once)
    gap = F.expr(f"INTERVAL '{interval_text(config.burst_gap)}'")
    elapsed = gap * F.coalesce(F.col("Bot_Sequence") - 1, F.lit(0))
    return rows.withColumn("Bot_Sequence", F.explode(copies)).withColumn(
        time, F.col(time) + elapsed
    )


def stamp(rows: DataFrame, key: str, time: str = "event_time") -> DataFrame:
    """Add ``Timestamp`` and ``Transaction_ID`` and drop the columns they came from."""
    return (
        rows.withColumn("Timestamp", iso_text(F.col(time)))
        .withColumn("Transaction_ID", transaction_id(F.col(time), F.col(key)))
        .drop(key, time)
    )


def envelope(transactions: DataFrame, leave_out: tuple[str, ...] = ("scenario",)) -> DataFrame:
    """Messages: the user as key (per-user partition affinity), the record as JSON value.

    NULL fields are left out of the JSON.
    """
    record = F.struct(*(f"`{c}`" for c in transactions.columns if c not in leave_out))
    return transactions.select(
        F.nullif(F.col("User_ID"), F.lit("")).cast("binary").alias("key"),
        F.to_json(record).cast("binary").alias("value"),
    )


def totals(transactions: DataFrame, config: FeedConfig = FeedConfig()) -> DataFrame:
    """One row of run totals over the replicated feed."""
    return transactions.agg(*total_measures(config))


def total_measures(config: FeedConfig = FeedConfig()) -> list[Column]:
    """Totals as aggregates, also usable with ``DataFrame.observe`` in a stream.

    Bursts are counted by their first row, and burst rows as bursts times their size.
    """
    scenario = F.col("scenario")
    bursts = F.count_if((scenario == BURST) & (F.col("Bot_Sequence") == 1))
    return [
        F.count("*").alias("total_sent"),
        F.count_if(scenario == NORMAL).alias("normal_count"),
        F.count_if(scenario == FRAUD).alias("fraud_count"),
        bursts.alias("bot_attacks"),
        (bursts * config.burst_rows).alias("bot_transactions"),
    ]
