"""Stateless outputs: ordinary transactions and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.config import DetectionConfig
from burstline.schemas import ALERT, NORMAL


def is_alert() -> Column:
    return (F.col("User_Status") == "BLOCKED") | (F.col("Class") == 1)


def is_normal(config: DetectionConfig = DetectionConfig()) -> Column:
    """NULL, hence not normal, where user or label is NULL."""
    kept_out = list(config.users_kept_out_of_normal)
    listed = ~F.col("User_ID").isin(kept_out) if kept_out else F.col("User_ID").isNotNull()
    return (F.col("User_Status") == "ACTIVE") & (F.col("Class") == 0) & listed


def with_alert_type(transactions: DataFrame) -> DataFrame:
    """Add ``Alert_Type``; a blocked user outranks a fraud label. ``SUSPICIOUS`` is left
    for rows that are neither, which the alert filter never lets through."""
    return transactions.withColumn(
        "Alert_Type",
        F.when(F.col("User_Status") == "BLOCKED", "BLOCKED_USER")
        .when(F.col("Class") == 1, "FRAUD_DETECTED")
        .otherwise("SUSPICIOUS"),
    )


def normal_transactions(
    enriched: DataFrame, config: DetectionConfig = DetectionConfig()
) -> DataFrame:
    return enriched.filter(is_normal(config)).select(*NORMAL.names)


def fraud_alerts(enriched: DataFrame) -> DataFrame:
    return with_alert_type(enriched.filter(is_alert())).select(*ALERT.names)


def with_route(enriched: DataFrame, config: DetectionConfig = DetectionConfig()) -> DataFrame:
    """Add ``Route``: normal, alert or unrouted, so that one scan can feed both outputs.

    The two outputs exclude each other but do not cover everything: listed users, unknown
    labels and undecodable messages are in neither.
    """
    return enriched.withColumn(
        "Route",
        F.when(is_alert(), "alert").when(is_normal(config), "normal").otherwise("unrouted"),
    )


def unrouted(enriched: DataFrame, config: DetectionConfig = DetectionConfig()) -> DataFrame:
    return with_route(enriched, config).filter(F.col("Route") == "unrouted").drop("Route")


def routed_transactions(
    enriched: DataFrame, config: DetectionConfig = DetectionConfig()
) -> DataFrame:
    """Both outputs as one: the alert columns plus ``Route``, for a sink split by route.

    ``Alert_Type`` is NULL on normal rows. One query decodes and joins each message once
    where two would do it twice.
    """
    routed = with_alert_type(with_route(enriched, config).filter(F.col("Route") != "unrouted"))
    alert_type = F.when(F.col("Route") == "alert", F.col("Alert_Type"))
    return routed.withColumn("Alert_Type", alert_type).select(*ALERT.names, "Route")
