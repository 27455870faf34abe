"""Sliding event-time aggregates: bursts per user and rolling totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.config import DetectionConfig, SlidingWindow
from burstline.schemas import BOT, SUMMARY


def _sliding(time: str, window: SlidingWindow) -> Column:
    return F.window(time, window.size_text, window.slide_text)


_CATEGORIES = ["Macro", "Micro", "Normal"]


def _time_and_category() -> Column:
    """Event time and category in one integer, time first.

    The smallest one is found by hash aggregation; ``min_by`` over text would sort every
    transaction first.
    """
    code = F.array_position(F.array(*map(F.lit, _CATEGORIES)), F.col("Category"))
    return F.unix_micros("event_time") * 4 + code


def _category_of(packed: str) -> Column:
    return F.try_element_at(
        F.array(*map(F.lit, _CATEGORIES)), F.pmod(F.col(packed), F.lit(4)).cast("int")
    )


def bot_windows(
    transactions: DataFrame,
    config: DetectionConfig = DetectionConfig(),
    sample_category: bool = False,
) -> DataFrame:
    """Count and amount per user and window, for windows above the threshold.

    Partial aggregation collapses a hot user before the shuffle, so what leaves a task is
    at most one row per user and window seen there. ``sample_category`` adds the category
    of the earliest transaction in the window, the alphabetically first among equals.
    """
    measures = [
        F.count("*").alias("transaction_count"),
        F.sum("Amount").alias("total_amount"),
    ]
    if sample_category:
        measures.append(F.min(_time_and_category()).alias("earliest"))
    alerts = (
        transactions.withWatermark("event_time", config.bot_window.watermark_text)
        .groupBy(_sliding("event_time", config.bot_window).alias("window"), "User_ID")
        .agg(*measures)
        .filter(F.col("transaction_count") > config.bot_more_than)
        .withColumn("Alert_Status", F.lit("BOT_DETECTED"))
        .withColumn("window_start", F.col("window.start"))
        .withColumn("window_end", F.col("window.end"))
        .drop("window")
    )
    if sample_category:
        alerts = alerts.withColumn("sample_category", _category_of("earliest")).drop("earliest")
    return alerts


def bot_detection(
    transactions: DataFrame, config: DetectionConfig = DetectionConfig()
) -> DataFrame:
    return bot_windows(transactions, config).select(*BOT.names)


def _counts() -> dict[str, Column]:
    return {
        "total_transactions": F.count("*"),
        "macro_count": F.count_if(F.col("Category") == "Macro"),
        "micro_count": F.count_if(F.col("Category") == "Micro"),
        "normal_count": F.count_if(F.col("Category") == "Normal"),
        "blocked_count": F.count_if(F.col("User_Status") == "BLOCKED"),
        "fraud_count": F.count_if(F.col("Class") == 1),
    }


def _summary_by_window(enriched: DataFrame, config: DetectionConfig) -> DataFrame:
    return enriched.groupBy(_sliding("event_time", config.summary_window).alias("window")).agg(
        *(measure.alias(name) for name, measure in _counts().items()),
        F.round(F.avg("Amount"), 2).alias("avg_amount"),
        F.round(F.sum("Amount"), 2).alias("total_amount"),
    )


def _summary_by_pane(
    enriched: DataFrame, config: DetectionConfig, chained: bool = False
) -> DataFrame:
    """Aggregate once per slide-wide pane, then add up the panes of each window.

    Each transaction updates one group and not size/slide of them, and the windows are
    built from the few pane rows. A pane lies in exactly the windows that hold its start,
    provided the slide divides the size. ``chained`` hands the watermark on with the pane,
    as the second aggregation of a stream needs it.
    """
    window = config.summary_window
    of_pane = "pane" if chained else "pane_start"
    counts = _counts()
    panes = (
        enriched.groupBy(F.window("event_time", window.slide_text).alias("pane"))
        .agg(
            *(measure.alias(name) for name, measure in counts.items()),
            F.count("Amount").alias("amounts"),
            F.sum("Amount").alias("amount"),
        )
        .withColumn("pane_start", F.col("pane.start"))
    )
    return (
        panes.groupBy(_sliding(of_pane, window).alias("window"))
        .agg(
            *(F.sum(name).alias(name) for name in counts),
            F.sum("amounts").alias("amounts"),
            F.sum("amount").alias("amount"),
        )
        .withColumn("avg_amount", F.round(F.try_divide("amount", "amounts"), 2))
        .withColumn("total_amount", F.round("amount", 2))
    )


def summary_statistics(
    enriched: DataFrame, config: DetectionConfig = DetectionConfig()
) -> DataFrame:
    """Counts and amounts of all transactions per sliding window.

    Update-mode streams allow one aggregation only, so panes are for batch.
    """
    marked = enriched.withWatermark("event_time", config.summary_window.watermark_text)
    if enriched.isStreaming or not config.summary_window.has_whole_panes:
        summary = _summary_by_window(marked, config)
    else:
        summary = _summary_by_pane(marked, config)
    return summary.select(*SUMMARY.names)


def closed_summary(
    enriched: DataFrame, config: DetectionConfig = DetectionConfig()
) -> DataFrame:
    """The summary of windows that are closed, for a stream in append mode: each window once.

    Two chained stateful aggregations, panes and then windows of panes. A transaction updates
    the state of one pane and not of size/slide windows, and the second state has a row per
    pane and window. The slide has to divide the size.
    """
    if not config.summary_window.has_whole_panes:
        raise ValueError("windows are no whole number of panes")
    marked = enriched.withWatermark("event_time", config.summary_window.watermark_text)
    return _summary_by_pane(marked, config, chained=True).select(*SUMMARY.names)


def flat_window(summary: DataFrame) -> DataFrame:
    """The window struct as two leading columns."""
    others = [name for name in summary.columns if name != "window"]
    return summary.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *others,
    )
