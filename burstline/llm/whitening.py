"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers, so counts, sums and deviations are exact. Rows are centred by the
exact mean and reduced, block after block, to the triangular factor of a QR factorisation; factors
of tasks are joined in a tree. What is left is one small matrix, as wide as the vectors: it is made
bidiagonal, dqds finds its singular values and twisted factorisations the directions of the largest
(:mod:`bidiagonal`). No product of the rows with themselves is formed, so small variances keep their
digits.

A pass over the rows each: their length, sums, factor, the check, the result. A task hands on one
row; joins of such rows are written, so a lost executor costs no pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.bidiagonal import principal
from burstline.llm.storage import Scratch

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
_LARGEST = 2.0**52
_ROWS_AT_ONCE = 4096
_JOINED_BYTES = 32 << 20


def _whole(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and whole-number entries of the usable vectors of a column."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(lengths == width)
    if not len(right):
        return right, np.zeros((0, width), np.int64)
    values = pc.list_flatten(column.take(pa.array(right)))
    entries = values.to_numpy(zero_copy_only=False).reshape(len(right), width)  # null: nan
    sound = np.isfinite(entries).all(1)
    entries = entries[sound] * float(SCALE)
    if np.abs(entries).max(initial=0.0) >= _LARGEST:
        raise ArithmeticError("an entry is too large to be a whole number of 1/1024")
    return right[sound], np.floor(entries).astype(np.int64) + SHIFT


def _per_task(
    vectors: DataFrame, width: int, start: Callable, add: Callable, end: Callable
) -> DataFrame:
    """One row per task, ``node`` and ``state``: what ``add`` makes of all usable vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            for first in range(0, len(batch), _ROWS_AT_ONCE):
                _, rows = _whole(batch.column("vector").slice(first, _ROWS_AT_ONCE), width)
                if len(rows):
                    state = add(state, rows)
        columns = [[TaskContext.get().partitionId()], [end(state)]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.float64()))],
            ["node", "state"],
        )

    return vectors.mapInArrow(run, "node long, state array<double>")


def _joined(parts: DataFrame, join: Callable, scratch: Scratch, name: str) -> np.ndarray | None:
    """The states of all tasks as one, joined in a tree whose nodes take a bounded size each."""
    parts = scratch.store(parts, f"{name}-0")
    last, size = parts.agg(F.max("node"), F.max(F.size("state"))).first()
    if last is None:
        return None
    fan = max(2, min(32, _JOINED_BYTES // (8 * max(size, 1))))
    level = 0

    def merge(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("node").to_numpy(), kind="stable").tolist()
        states = [np.array(table.column("state")[k].as_py(), np.float64) for k in order]
        state = states[0]
        for other in states[1:]:
            state = join(state, other)
        node = table.column("node").to_numpy().min() // fan
        return pa.table(
            {
                "node": pa.array([node], pa.int64()),
                "state": pa.array([state], pa.list_(pa.float64())),
            }
        )

    while last > 0:
        level += 1
        groups = parts.groupBy(F.floor(F.col("node") / fan))
        parts = scratch.store(groups.applyInArrow(merge, parts.schema), f"{name}-{level}")
        last //= fan
    return np.array(parts.first().state, np.float64)


def _factor(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of a block, square whatever the number of its rows."""
    width = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((width - len(r), width))])


class Whitening:
    """What is known of a table: ``n`` vectors, exact ``sums``, ``values`` (falling variances) and
    ``vectors`` (their directions, one per row), the ``trace`` and the ``identity_error``."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, np.array(sums, np.int64)
        self.width = len(sums)
        self.values, self.vectors = np.zeros(0), np.zeros((0, self.width))
        self.trace = self.identity_error = 0.0

    def _off(self, rows: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        largest = max(abs(int(rows.max())), abs(int(rows.min())), 1) * self.n
        if 2 * largest >= 2**63:
            raise ArithmeticError("n times an entry is beyond a long")
        return rows * self.n - self.sums

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return self._off(rows) / float(self.n)

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """The squared lengths of n x - S, exact or refused."""
        off = self._off(rows)
        if float(np.abs(off).max(initial=0)) ** 2 * self.width < 2.0**62:
            return (off * off).sum(1)
        exact = [sum(int(c) ** 2 for c in row) for row in off]
        if max(exact) >= 2**63:
            raise ArithmeticError("a deviation is beyond a long")
        return np.array(exact, np.int64)

    def project(self, rows: np.ndarray) -> np.ndarray:
        return (self.centred(rows) @ self.vectors.T) / np.sqrt(self.values)


def _moments(state: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Adds a block: count, mean and products of what differs from the mean."""
    mean = rows.mean(0)
    off = rows - mean
    return _joined_moments(state, np.concatenate([[len(rows)], mean, (off.T @ off).ravel()]), k)


def _joined_moments(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    n = a[0] + b[0]
    if n == 0:
        return a
    off = b[1 : k + 1] - a[1 : k + 1]
    mean = a[1 : k + 1] + off * (b[0] / n)
    products = a[k + 1 :] + b[k + 1 :] + np.outer(off, off).ravel() * (a[0] * b[0] / n)
    return np.concatenate([[n], mean, products])


def fit(
    vectors: DataFrame,
    components: int = COMPONENTS,
    column: str = "embedding",
    scratch: Scratch | None = None,
) -> Whitening | None:
    """Fits on all usable vectors; None if there is none.

    A vector is dropped if it is null or empty, holds null or non-finite entries, or is not of the
    length that most vectors of the table have (the longest of equally frequent ones), so that
    entries are missing or too many. An entry of 2^42 or more, or a sum beyond a long, is an
    error. Directions without variance are no components, so one vector has none.
    """
    scratch = scratch or Scratch(vectors.sparkSession, "whitening")
    chosen = vectors.select(F.col(column).cast("array<double>").alias("vector"))
    sizes = chosen.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("width")).count()
    usual = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None:
        return None
    width = usual.width

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, object)
        for batch in batches:
            for first in range(0, len(batch), _ROWS_AT_ONCE):
                _, rows = _whole(batch.column("vector").slice(first, _ROWS_AT_ONCE), width)
                n += len(rows)
                total = total + (rows.astype(object) if _wide(rows) else rows).sum(0)
        places = range(-1, width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int32()), pa.array([n, *map(int, total)], pa.int64())],
            ["place", "part"],
        )

    parts = scratch.store(chosen.mapInArrow(sums, "place int, part long"), "sums")
    # One number per dimension; -1 is the count.
    summed = parts.groupBy("place").agg(F.sum("part").alias("total")).collect()
    totals = {row.place: row.total for row in summed}
    if not totals.get(-1):
        return None
    known = Whitening(totals[-1], [totals[k] for k in range(width)])

    def add(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return _factor(np.vstack([r, known.centred(rows)]))

    factors = _per_task(chosen, width, lambda: np.zeros((width, width)), add, np.ravel)

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _factor(np.vstack([a.reshape(width, width), b.reshape(width, width)])).ravel()

    r = _joined(factors, join, scratch, "factors").reshape(width, width)
    squares, known.vectors = principal(r, components)
    known.values = squares / known.n
    known.trace = float((r * r).sum()) / known.n
    k = len(known.values)
    if k:
        moments = _per_task(
            chosen,
            width,
            lambda: np.zeros(1 + k + k * k),
            lambda state, rows: _moments(state, known.project(rows), k),
            lambda state: state,
        )
        state = _joined(moments, lambda a, b: _joined_moments(a, b, k), scratch, "moments")
        covariance = state[k + 1 :].reshape(k, k) / state[0]
        known.identity_error = float(np.abs(covariance - np.eye(k)).max())
    return known


def _wide(rows: np.ndarray) -> bool:
    """Whether sums of a block may go beyond a long."""
    return bool(len(rows)) and float(np.abs(rows).max()) * len(rows) >= 2.0**62


WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_column: str = "vec_id",
    column: str = "embedding",
) -> DataFrame:
    """One row per usable vector and component, components numbered from 1 by falling variance.

    ``deviation`` is the exact squared length of n x - S, ``whitened`` the centred vector along the
    component over the root of its variance, ``explained`` the component's share of all variance,
    ``identity_error`` how far the covariance of ``whitened`` is from the identity. What vectors
    are usable, see :func:`fit`. Null ids stay null, rows that share an id stay rows of their own;
    other columns are not read. A table without usable vectors, or without variance, gives no rows.
    """
    spark = vectors.sparkSession
    known = fit(vectors, components, column)
    names = [x.split()[0] for x in WHITENED.split(", ")]
    if known is None or not len(known.values):
        return spark.createDataFrame([], WHITENED)
    k = len(known.values)
    shares = known.values / known.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), _ROWS_AT_ONCE):
                some = batch.slice(first, _ROWS_AT_ONCE)
                at, rows = _whole(some.column("vector"), known.width)
                if not len(rows):
                    continue
                where = pa.array(np.repeat(at, k))
                columns = [
                    some.column("vec_id").take(where),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, known.n, np.int64)),
                    pa.array(np.repeat(known.deviations(rows), k)),
                    pa.array(known.project(rows).ravel()),
                    pa.array(np.tile(shares, len(rows))),
                    pa.array(np.full(len(rows) * k, known.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(column).cast("array<double>").alias("vector"),
    )
    return chosen.mapInArrow(run, WHITENED)
