"""Small files that are replaced whole: which snapshot or base is the one to read.

Spark writes tables but has no atomic replacement of a small file, so this goes through the Hadoop
file system of the session, the one that Spark's own checkpoints use: a new file is written beside
the old one and renamed over it. A reader sees the old file or the new one, never a part.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession


class Folder:
    """A folder on the file system that its URI names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names in the folder or in one below it, sorted; none if there is no such folder."""
        at = self._at(name) if name else self._root
        if not self._fs.exists(at):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(at))

    def read(self, name: str) -> dict | None:
        """A small JSON file, or None if there is none."""
        if not self.exists(name):
            return None
        stream = self._fs.open(self._at(name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def replace(self, name: str, content: Mapping) -> None:
        """Writes a small JSON file in place of the old one, in one step."""
        fresh = self._at(f"_{name.lstrip('_')}-{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(fresh, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self._conf
        )
        rename = self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        over = self._jvm.java.lang.reflect.Array.newInstance(rename, 1)
        over[0] = rename.getEnumConstants()[1]  # OVERWRITE
        context.rename(fresh, self._at(name), over)

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
