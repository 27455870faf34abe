"""A reference table that can be replaced while queries read it.

Each version is a snapshot of its own, written once and never changed. A pointer, replaced in one
step, names the current one. A running query resolves the pointer when it wants to: a batch query
when it starts, a stream per micro-batch. What a micro-batch has resolved is pinned under its
number, so a batch that is repeated after a failure reads the same version and gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from burstline.streaming.pointer import Folder

_POINTER = "_current"
_PREFIX = "snapshot="


class Snapshots:
    """Numbered snapshots of one table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        """All snapshots, those too that were written but never published."""
        names = (name for name in self.folder.names() if name.startswith(_PREFIX))
        return sorted(int(name.removeprefix(_PREFIX)) for name in names)

    def current(self) -> int | None:
        found = self.folder.read(_POINTER)
        return None if found is None else found["snapshot"]

    def publish(self, rows: DataFrame) -> int:
        """Writes a new snapshot and makes it the current one. If two publish at once, one of
        them fails, as no snapshot is ever written over."""
        number = max(self.numbers(), default=0) + 1
        rows.write.mode("errorifexists").parquet(self._path(number))
        self.folder.replace(_POINTER, {"snapshot": number})
        return number

    def read(self, schema: StructType, number: int | None = None) -> DataFrame:
        """A snapshot, the current one unless a number is given."""
        number = self.current() if number is None else number
        if number is None:
            raise FileNotFoundError(f"nothing has been published in {self.folder.path}")
        return self.spark.read.schema(schema).parquet(self._path(number))

    def pinned(self, batch: int, log: str) -> int:
        """The snapshot of a micro-batch: the current one at its first try, the same ever after.
        ``log`` is a folder of the query's own."""
        pins = Folder(self.spark, log)
        name = f"batch-{batch}.json"
        found = pins.read(name)
        if found is None:
            found = {"snapshot": self.current()}
            if found["snapshot"] is None:
                raise FileNotFoundError(f"nothing has been published in {self.folder.path}")
            pins.replace(name, found)
        return found["snapshot"]

    def expire(self, keep: int = 2) -> list[int]:
        """Removes all but the newest snapshots, never the current one or a newer one. Queries
        that still read an older one will fail, so keep as many as may be in use."""
        if keep < 1:
            raise ValueError("the current snapshot stays")
        current = self.current()
        old = [n for n in self.numbers() if current is not None and n <= current][:-keep]
        for number in old:
            self.folder.remove(f"{_PREFIX}{number}")
        return old

    def _path(self, number: int) -> str:
        return f"{self.folder.path}/{_PREFIX}{number}"
