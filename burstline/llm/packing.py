"""Packing by vector bin packing: the dot-product heuristic under three limits at once.

A sequence has a limit on tokens, segments and loss-bearing tokens. The packer keeps a bounded
pool of open examples and fills one sequence at a time: of the examples that fit, it takes the
one whose demand has the largest dot product with what is left of the limits, both as shares of
the limits. So whatever is scarce in the sequence decides what goes in next.

Each task packs the rows it has read, so nothing is shuffled, and a task leaves at most a few
sequences partly filled. A task that is run again after a loss packs the same way.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.storage import lean
from burstline.llm.units import unit_ids

SEPARATOR = 0
_EMIT = 8192
_SLOTS = 1 << 18  # packing shares its workers with other stages


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 1024
    segments: int = 256
    loss_tokens: int = 1024


class Packer:
    """Fills sequences from a pool of examples (key, tokens, loss-bearing tokens).

    With ``cut`` an example too large for what is left of a sequence may be cut there, from
    ``least_piece`` tokens on; the key is then a pair (key, tokens before this piece). Cutting
    assumes that all tokens of a piece bear loss but its first, which has nothing before it.
    Without ``cut`` an example over a limit is a sequence of its own.
    """

    def __init__(self, limits: Limits, pool: int = 512, cut: bool = False, least_piece: int = 4):
        self.limits, self.pool, self.cut, self.least_piece = limits, pool, cut, least_piece
        room = 2 * pool
        self.demand = np.zeros((3, room))
        self.keys: list = [None] * room
        self.n = 0
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
        self.next_sequence = 0

    def add(self, key, tokens: int, loss: int) -> Iterator[list]:
        """Takes an example and gives the sequences that it completes."""
        if not self.cut and (tokens > self.limits.tokens or loss > self.limits.loss_tokens):
            yield [(key, tokens)]
            return
        self._put(key, tokens, loss)
        while self.n >= self.pool:
            yield self._fill()

    def rest(self) -> Iterator[list]:
        while self.n:
            yield self._fill()

    def _put(self, key, tokens: int, loss: int) -> None:
        self.demand[:, self.n] = tokens, 1, loss
        self.keys[self.n] = key
        self.n += 1

    def _take(self, k: int):
        key, tokens = self.keys[k], int(self.demand[0, k])
        last = self.n - 1
        self.demand[:, k] = self.demand[:, last]
        self.keys[k], self.keys[last] = self.keys[last], None
        self.n = last
        return key, tokens

    def _fill(self) -> list:
        left, placed = self.capacity.copy(), []
        while self.n and left[0] > 0 and left[1] > 0:
            demand = self.demand[:, : self.n]
            score = (left / self.capacity**2) @ demand
            fits = (demand[0] <= left[0]) & (demand[2] <= left[2])
            if fits.any():
                k = int(np.where(fits, score, -1.0).argmax())
                left -= demand[:, k]
                placed.append(self._take(k))
                continue
            room = int(min(left[0], left[2] + 1))
            if not self.cut or room < self.least_piece:
                break
            k = int(score.argmax())
            (key, before), tokens = self._take(k)
            placed.append(((key, before), room))
            self._put((key, before + room), tokens - room, tokens - room - 1)
            break
        return placed


def pack_examples(
    examples: DataFrame,
    limits: Limits = Limits(),
    id_column: str = "id",
    tokens: str = "tokens",
    loss_tokens: str = "loss_tokens",
    pool: int = 512,
) -> DataFrame:
    """Whole examples, never cut, as sequences: adds ``sequence_id`` and ``offset``.

    Null counts are 0. An example over a limit is alone in its sequence, ``oversized`` true. Rows with equal ids are examples of their own.
    The id column keeps its name and type; other columns are left out.
    """
    chosen = examples.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.col(tokens).cast("long"), F.lit(0)).alias("_tokens"),
        F.coalesce(F.col(loss_tokens).cast("long"), F.lit(0)).alias("_loss"),
    )
    id_type = chosen.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base, sequence = Packer(limits, pool), TaskContext.get().partitionId() << 33, 0
        rows: list[tuple] = []

        def place(done: list) -> None:
            nonlocal sequence
            offset = 0
            for (key, loss), n in done:
                over = n > limits.tokens or loss > limits.loss_tokens
                rows.append((key, n, loss, base + sequence, offset, over))
                offset += n
            sequence += 1

        def table(kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            rows.clear()
            return pa.RecordBatch.from_arrays(
                columns, ["_id", "tokens", "loss_tokens", "sequence_id", "offset", "oversized"]
            )

        kind = None
        for batch in batches:
            kind = batch.schema.field("_id").type
            for key, n, loss in zip(*(c.to_pylist() for c in batch.columns)):
                for done in packer.add((key, loss), n, loss):
                    place(done)
                if len(rows) >= _EMIT:
                    yield table(kind)
        for done in packer.rest():
            place(done)
        if rows:
            yield table(kind)

    schema = (
        f"_id {id_type}, tokens long, loss_tokens long, sequence_id long, offset long, "
        "oversized boolean"
    )
    return chosen.mapInArrow(run, schema).withColumnRenamed("_id", id_column)


def conversation_examples(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Instruction examples: per conversation its tokens and those of the assistant, which bear
    loss. Each turn ends with the separator. Null texts are empty, null roles bear no loss."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(tokenizer_path, _SLOTS)
        for batch in batches:
            lengths = [len(x) + 1 for x in units.encode(batch.column("text"))]
            columns = [batch.column("conv_id"), batch.column("role"), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "role", "n"])

    turns = conversations.select(F.col("conv_id").cast("long"), "role", "text")
    counted = turns.mapInArrow(count, "conv_id long, role string, n long")
    loss = F.when(F.col("role") == "assistant", F.col("n")).otherwise(0)
    return counted.groupBy("conv_id").agg(
        F.sum("n").alias("tokens"), F.sum(loss).alias("loss_tokens")
    )


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long, loss_tokens long"
)


def pack_documents(
    documents: DataFrame, tokenizer_path: str, limits: Limits = Limits(), pool: int = 512
) -> DataFrame:
    """Tokenizes documents, ends each with id 0, and packs them, cutting where it fills.

    One row per piece. A document longer than a sequence first fills whole sequences; what is
    left goes to the packer. Null texts are empty and give the separator alone; rows with equal
    or null ids are documents of their own; other columns are not read.
    ``sequence_tokens`` is the fill of the piece's sequence, ``loss_tokens`` what of the piece
    bears loss.
    """
    if limits.loss_tokens + 1 < limits.tokens:
        whole = limits.loss_tokens + 1
    else:
        whole = limits.tokens
    names = [x.split()[0] for x in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(tokenizer_path, _SLOTS)
        packer = Packer(limits, pool, cut=True)
        base, sequence = TaskContext.get().partitionId() << 33, 0
        open_ids: dict[int, tuple] = {}  # documents with pieces in the pool
        rows: list[tuple] = []

        def place(done: list) -> None:
            nonlocal sequence
            fill, offset = sum(n for _, n in done), 0
            for (number, start), n in done:
                doc_id, first, ids, total = open_ids[number]
                piece = ids[start - first : start - first + n]
                rows.append(
                    (doc_id, start, n, zlib.crc32(piece.astype("<u4").tobytes()), total)
                    + (base + sequence, offset, fill, n - 1)
                )
                offset += n
                if start + n == total:
                    del open_ids[number]
            sequence += 1

        def table() -> pa.RecordBatch:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            rows.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        number = 0
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for first in range(0, len(doc_ids), 1000):
                some = units.encode(texts.slice(first, 1000))
                for doc_id, ids in zip(doc_ids[first : first + 1000], some):
                    ids = np.append(ids, np.uint32(SEPARATOR))
                    total, start = len(ids), 0
                    open_ids[number] = (doc_id, 0, ids, total)
                    while total - start >= whole:
                        place([((number, start), whole)])
                        start += whole
                    if start < total:
                        open_ids[number] = (doc_id, start, ids[start:].copy(), total)
                        left = total - start
                        for done in packer.add((number, start), left, left - 1):
                            place(done)
                    number += 1
                    if len(rows) >= _EMIT:
                        yield table()
        for done in packer.rest():
            place(done)
        if rows:
            yield table()

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(lean(run), PIECES)
