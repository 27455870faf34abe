"""Where checkpoints and written tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SHARED_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local master, whose driver and tasks share one disk, may fall back to a
    temporary folder.
    """
    root = spark.conf.get(_SHARED_DIR, None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="burstline-")
    raise ValueError(f"set {_SHARED_DIR} to a folder that all executors can reach")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder path for one run."""
    return f"{shared_root(spark)}/burstline/{name}-{uuid.uuid4().hex}"
