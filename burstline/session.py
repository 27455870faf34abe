"""Spark sessions for the jobs and for stateful queries."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Zone-less ISO timestamps are read in the session zone, so it is pinned. AQE picks
# join strategies from real sizes and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
_CHANGE_LOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
STATE_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, _CHANGE_LOG: "true"}


_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(app_name: str = "burstline", **settings: str) -> SparkSession:
    """Session of a stand-alone job; ``spark-submit`` and ``SPARK_MASTER`` name the master.

    Batch shuffles start with several partitions per core and AQE merges small ones, so
    their number follows the cluster and the data. Streams use
    ``spark.sql.shuffle.partitions``, which is left to the caller.
    """
    builder = SparkSession.builder.appName(app_name)
    if "SPARK_MASTER" in os.environ:
        builder = builder.master(os.environ["SPARK_MASTER"])
    for key, value in {**SETTINGS, **STATE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if spark.conf.get(_INITIAL_PARTITIONS, None) is None:
        spark.conf.set(_INITIAL_PARTITIONS, str(4 * _default_width(spark)))
    return spark


def stateful_session(
    spark: SparkSession, state_partitions: int | None = None, change_log: bool = True
) -> SparkSession:
    """A sibling session (same cluster, own settings) for streaming queries.

    The shuffle width of a stateful query is frozen in its checkpoint, so it is chosen
    here: the number given, or one state partition per core.

    With ``change_log`` a batch stores what it has changed, which is least for a query that runs
    on. A start applies all changes since the last snapshot again, so a query that is started anew
    for every few large batches stores its state as files instead.
    """
    sibling = spark.newSession()
    for key, value in {**SETTINGS, **STATE_SETTINGS}.items():
        sibling.conf.set(key, value)
    sibling.conf.set(_CHANGE_LOG, str(change_log).lower())
    sibling.conf.set(_SHUFFLE_PARTITIONS, str(state_partitions or _default_width(spark)))
    return sibling


def _default_width(spark: SparkSession) -> int:
    cores = spark.sparkContext.defaultParallelism
    if spark.sparkContext.master.startswith("local"):
        return cores
    # A cluster that allocates executors on demand may show few cores at first.
    return max(cores, int(spark.conf.get(_SHUFFLE_PARTITIONS)))
