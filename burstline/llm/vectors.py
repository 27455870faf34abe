"""Near-dedup of embeddings by a pivot-permutation index.

A vector is described by its nearest pivots: reference vectors drawn from the table and mutually
apart. Inverted lists hold the vectors that have a pivot among their nearest ones. Vectors that
share enough pivots are candidates, and candidates are verified by cosine in double precision.

Equal vectors are one class. A list too long for a task is cut in blocks and every pair of blocks
is a group of its own, so a pivot that a third of all vectors are near to is many tasks. A pair
found in several lists is verified in that of its first common pivot. Tasks give back sums and
spanning links, at most one row per vector, never the pairs.

Pivots are the only thing sampled (``PIVOTS_AT`` and a share that grows with the root of the
rows); every vector is indexed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.components import components
from burstline.llm.storage import Scratch, values

NEAREST = 8
SHARED = 2
PIVOTS_AT = (256, 10_000)  # so many pivots at so many vectors
MOST_PIVOTS = 2048
APART = 0.7  # no two pivots are closer than this
DRAWN_PER_PIVOT = 4
BLOCK = 2048
_PAIRS_AT_ONCE = 100_000


def _prepared(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """Unit vectors as bytes, zeros filled in to the longest length, with a hash of them; null
    for vectors that link with nothing."""
    chosen = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(column).cast("array<double>").alias("vector"),
    )
    width = chosen.agg(F.max(F.size("vector"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            units, highs, lows = [], [], []
            for vector in values(batch.column("vector")):
                unit = _unit(vector, width)
                whole = xxhash.xxh3_128_intdigest(unit) if unit is not None else None
                units.append(unit)
                highs.append(None if whole is None else (whole >> 64) - (1 << 63))
                lows.append(None if whole is None else (whole & (2**64 - 1)) - (1 << 63))
            columns = [batch.column("vec_id"), pa.array(units, pa.binary())]
            columns += [pa.array(x, pa.int64()) for x in (highs, lows)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "unit", "high", "low"])

    return chosen.mapInArrow(run, "vec_id long, unit binary, high long, low long")


def _unit(vector: list | None, width: int) -> bytes | None:
    if not vector or None in vector:
        return None
    x = np.array(vector, np.float64)
    largest = np.abs(x).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    x = x / largest  # neither overflows nor vanishes when squared
    x = x / np.sqrt(x @ x) + 0.0  # no negative zeros
    return np.concatenate([x, np.zeros(width - len(x))]).tobytes()


def pivots_for(rows: int) -> int:
    pivots, at = PIVOTS_AT
    return int(min(MOST_PIVOTS, max(16, pivots * math.sqrt(rows / at))))


def _pivots(reps: DataFrame, rows: int) -> np.ndarray:
    """Unit vectors drawn by a hash of the id, without those close to one drawn before."""
    wanted = pivots_for(rows)
    drawn = reps.orderBy(F.xxhash64("rep")).limit(DRAWN_PER_PIVOT * wanted).select("unit")
    found: list[np.ndarray] = []
    for row in drawn.collect():  # at most 8192 vectors
        x = np.frombuffer(row.unit, np.float64)
        if len(found) < wanted and (not found or (np.stack(found) @ x).max() < APART):
            found.append(x)
    return np.stack(found) if found else np.zeros((0, 0))


def _indexed(reps: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds the nearest pivots, nearest first."""
    sent = reps.sparkSession.sparkContext.broadcast(pivots)  # at most MOST_PIVOTS vectors
    nearest = min(NEAREST, len(pivots))

    def near(units: pa.Array) -> pa.Array:
        rows = []
        for first in range(0, len(units), 1024):
            some = units.slice(first, 1024).to_pylist()
            x = np.frombuffer(b"".join(some), np.float64).reshape(len(some), -1)
            close = x @ sent.value.T
            rows.append(np.argsort(-close, axis=1, kind="stable")[:, :nearest])
        return pa.array(list(np.concatenate(rows).astype(np.int32)), pa.list_(pa.int32()))

    return reps.withColumn("near", F.arrow_udf(near, "array<int>")("unit"))


def _blocks(indexed: DataFrame) -> DataFrame:
    """The inverted lists, cut in pairs of blocks of bounded size."""
    lists = indexed.select("rep", "rows", "unit", "near", F.explode("near").alias("pivot"))
    lengths = lists.groupBy("pivot").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK)
    lengths = lengths.select(F.col("pivot"), blocks.cast("int").alias("blocks"))
    # One row per pivot, of which there are MOST_PIVOTS at most.
    placed = lists.join(F.broadcast(lengths), "pivot")
    placed = placed.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.select(
        "pivot",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "rep",
        "rows",
        "unit",
        "near",
    )


def candidates(near_a: np.ndarray, near_b: np.ndarray, pivot: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that share enough pivots, of which ``pivot`` is the first (smallest)."""
    known, places = np.unique(np.concatenate([near_a, near_b]), return_inverse=True)
    places = places.reshape(-1, near_a.shape[1])
    held = np.zeros((len(places), len(known)), np.float32)
    held[np.arange(len(places))[:, None], places] = 1
    shared = held[: len(near_a)] @ held[len(near_a) :].T
    a, b = np.nonzero(shared >= min(SHARED, near_a.shape[1]))
    keep = []
    for first in range(0, len(a), _PAIRS_AT_ONCE):
        x, y = near_a[a[first : first + _PAIRS_AT_ONCE]], near_b[b[first : first + _PAIRS_AT_ONCE]]
        common = (x[:, :, None] == y[:, None, :]).any(2)
        keep.append(np.where(common, x, np.iinfo(np.int32).max).min(1) == pivot)
    kept = np.concatenate(keep) if keep else np.zeros(0, bool)
    return a[kept], b[kept]


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root, new)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _linked(blocks: DataFrame, least_cosine: float) -> DataFrame:
    """Of each vector with links in a group: how many rows it links with, and the smallest
    vector that it reaches inside the group."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        pivot, low, high = (x.as_py() for x in key)
        reps = table.column("rep").to_numpy()
        rows = table.column("rows").to_numpy()
        own = table.column("own").to_numpy()
        order = np.argsort(reps, kind="stable")
        reps, rows, own = reps[order], rows[order], own[order]
        units = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64)
        units = units.reshape(len(reps), -1)[order]
        near = np.array(table.column("near").to_pylist(), np.int32)[order]
        left = np.flatnonzero(own == low)
        right = np.flatnonzero(own == high)
        a, b = candidates(near[left], near[right], pivot)
        a, b = left[a], right[b]
        if low == high:
            a, b = a[a < b], b[a < b]
        close = []
        for first in range(0, len(a), _PAIRS_AT_ONCE):
            x, y = a[first : first + _PAIRS_AT_ONCE], b[first : first + _PAIRS_AT_ONCE]
            close.append(np.einsum("ij,ij->i", units[x], units[y]) >= least_cosine)
        linked = np.concatenate(close) if close else np.zeros(0, bool)
        a, b = a[linked], b[linked]
        sums = np.bincount(a, rows[b], len(reps)) + np.bincount(b, rows[a], len(reps))
        roots = reps[_roots(len(reps), a, b)]
        some = np.flatnonzero(sums > 0)
        return pa.table(
            {
                "rep": pa.array(reps[some], pa.int64()),
                "n": pa.array(sums[some].astype(np.int64)),
                "root": pa.array(roots[some], pa.int64()),
            }
        )

    groups = blocks.groupBy("pivot", "low", "high")
    return groups.applyInArrow(compare, "rep long, n long, root long")


def near_duplicates(
    vectors: DataFrame,
    least_cosine: float = 0.9,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row per input row.

    Vectors found with a cosine of ``least_cosine`` or more are linked. ``n_links`` counts rows.
    Vectors that are null, empty or zero or hold null or non-finite components link with
    nothing; shorter ones are compared as if filled up with zeros. Rows without id are kept,
    with no links and a null component; rows that share an id share its component.
    """
    scratch = Scratch(vectors.sparkSession, "vectors")
    prepared = scratch.store(_prepared(vectors, id_column, column), "prepared")
    usable = prepared.filter(F.col("vec_id").isNotNull() & F.col("unit").isNotNull())
    one = ["high", "low"]
    classes = usable.groupBy(*one).agg(F.min("vec_id").alias("rep"), F.count("*").alias("rows"))
    classes = scratch.store(classes, "classes")
    reps = usable.join(classes, one).filter(F.col("vec_id") == F.col("rep"))
    reps = scratch.store(reps.dropDuplicates(["rep", *one]).select("rep", "rows", "unit"), "reps")

    pivots = _pivots(reps, reps.count())
    if len(pivots):
        indexed = scratch.store(_indexed(reps, pivots), "indexed")
        found = scratch.store(_linked(_blocks(indexed), least_cosine), "found")
    else:
        found = classes.select("rep", F.col("rows").alias("n"), F.col("rep").alias("root"))
    stars = components(found.select("rep", "root"), scratch)
    sums = found.groupBy("rep").agg(F.sum("n").alias("n"))
    labels = stars.select(F.col("node").alias("rep"), "component")
    known = classes.join(sums, "rep", "left").join(labels, "rep", "left")
    known = known.select(
        *one,
        (F.coalesce("n", F.lit(0)) + F.col("rows") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component"),
    )
    known = scratch.store(known, "known")
    scratch.drop("reps", "indexed", "found", "classes")
    joined = prepared.drop("unit").join(known, one, "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    links = F.when(F.col("vec_id").isNotNull(), F.col("n_links"))
    return joined.select(
        "vec_id",
        F.coalesce(links, F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
