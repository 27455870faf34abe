"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from burstline.streaming.workspace import run_folder


# Rows with texts or sets are large, and a batch is held by the JVM and by Python.
ROWS_AT_ONCE = 1000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Scratch:
    """Written tables of one run. Writing cuts lineage, and a lost executor loses none of it."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = run_folder(spark, name)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def store(self, frame: DataFrame, name: str) -> DataFrame:
        conf = self.spark.conf
        before = conf.get(_ARROW_ROWS)
        conf.set(_ARROW_ROWS, str(min(ROWS_AT_ONCE, int(before))))
        try:
            frame.write.mode("overwrite").parquet(self.path(name))
        finally:
            conf.set(_ARROW_ROWS, before)
        return self.spark.read.schema(frame.schema).parquet(self.path(name))

    def release(self) -> None:
        """Lets Spark's cleaner remove the shuffle files of finished steps before the next one:
        it does so once their plans are garbage."""
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *names: str) -> None:
        """Removes tables that no later step reads."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release_unused() -> None:
    """Gives the system back what allocators keep of memory that is no longer used. Python workers
    go from task to task, and an executor's limit is for all of them and the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` whose tasks end with :func:`release_unused`."""

    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_unused()

    return task


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """Names for helper columns that none of the given columns has, in any case of letters."""
    taken, found = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def values(column: pa.Array, at_once: int = 256) -> Iterator:
    """The values of an Arrow column as Python objects, few of them alive at a time."""
    for first in range(0, len(column), at_once):
        yield from column.slice(first, at_once).to_pylist()
