"""The change log of an update-mode query: batches, and a base that they are added up to.

    batch_id=17/...      changes of a micro-batch, replaced whole if the batch is repeated
    _base/16-<id>/...    the newest state of each key through batch 16
    _manifest            which base counts, and through which batch

A compaction writes a new base beside the old one and then replaces the manifest in one step. If
it is lost before that, nothing has changed; a reader takes the manifest whole, so it sees the old
base with all later batches or the new one with those after it. Nothing a reader may be using is
removed until :func:`vacuum` is called.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.streaming.pointer import Folder

BATCH = "batch_id"
_MANIFEST, _BASE, _DONE = "_manifest", "_base", "_SUCCESS"


@dataclass(frozen=True)
class Compaction:
    """The keys of a log, and after how many batches it is compacted."""

    keys: Sequence[str]
    every: int = 100


def _manifest(folder: Folder) -> tuple[str | None, int]:
    found = folder.read(_MANIFEST) or {"base": None, "through": -1}
    return found["base"], found["through"]


def _batches(folder: Folder, after: int) -> list[int]:
    """Batches that were stored to their end, later than the given one."""
    prefix = f"{BATCH}="
    numbers = [int(n.removeprefix(prefix)) for n in folder.names() if n.startswith(prefix)]
    return [n for n in sorted(numbers) if n > after and folder.exists(f"{prefix}{n}/{_DONE}")]


def _newest(
    spark: SparkSession, path: str, keys: Sequence[str], base: str | None, batches: Sequence[int]
) -> DataFrame:
    """The newest row per key, with the batch that it is from."""
    parts = []
    if batches:
        folders = [f"{path}/{BATCH}={n}" for n in batches]
        log = spark.read.option("basePath", path).parquet(*folders)
        parts.append(log.withColumn(BATCH, F.col(BATCH).cast("bigint")))
    if base is not None:
        parts.append(spark.read.parquet(f"{path}/{base}"))
    log = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    measures = [c for c in log.columns if c not in keys and c != BATCH]
    return log.groupBy(*keys).agg(
        *(F.max_by(c, BATCH).alias(c) for c in measures), F.max(BATCH).alias(BATCH)
    )


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest state of each key: the base and the batches after it, no others.

    One hash aggregation, as long as the non-key columns are numbers; name constant text
    columns among the keys.
    """
    folder = Folder(spark, path)
    base, through = _manifest(folder)
    batches = _batches(folder, through)
    if base is None and not batches:
        raise FileNotFoundError(f"no batch has been stored in {path}")
    return _newest(spark, path.rstrip("/"), keys, base, batches).drop(BATCH)


def compact(spark: SparkSession, path: str, keys: Sequence[str]) -> int:
    """Makes a base of the old one and all stored batches; returns the last batch in it.

    A batch that is repeated after it went into the base writes the same rows again and is not
    read any more.
    """
    folder = Folder(spark, path)
    base, through = _manifest(folder)
    batches = _batches(folder, through)
    if not batches:
        return through
    name = f"{_BASE}/{batches[-1]}-{uuid.uuid4().hex}"
    newest = _newest(spark, path.rstrip("/"), keys, base, batches)
    newest.write.mode("errorifexists").parquet(f"{path}/{name}")
    folder.replace(_MANIFEST, {"base": name, "through": batches[-1]})
    return batches[-1]


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Removes the batches that are in the base and all other bases, among them what a lost
    compaction has left. Call it when no reader is older than the manifest."""
    folder = Folder(spark, path)
    base, through = _manifest(folder)
    prefix = f"{BATCH}="
    gone = [
        name
        for name in folder.names()
        if name.startswith(prefix) and int(name.removeprefix(prefix)) <= through
    ]
    bases = (f"{_BASE}/{name}" for name in folder.names(_BASE))
    gone += [name for name in bases if name != base]
    for name in gone:
        folder.remove(name)
    return gone
