"""Token ids in files: adaptive context mixing and a range coder in independent blocks.

A file is a row of chunks. A chunk has a head and coded blocks. The head, with its own checksum,
lists the pieces of documents in the chunk (id, how many ids, whether the document ends), the ids by
frequency, whose places are the ranks that :mod:`mixing` codes, and of each block its size, the
checksum of its bytes and that of its ids. A block can be decoded with the head alone. The file ends
with counts, so that a file cut short is noticed.

Documents are dealt out in ranges of their id, sorted, and a task writes one file per range, so ids
stand in the files in the order of the documents. A task that is run again writes a file of a new
name; the table of files, itself written by Spark, says which ones count. Memory is bounded by the
chunk, however long a document is. A table of one row per file gives where each file starts.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstline.llm import mixing
from burstline.llm.storage import Scratch
from burstline.llm.units import unit_ids

END = 2
MAGIC = b"CMIXIDS1"
CHUNK, DONE = b"CHNK", b"DONE"
CHUNK_IDS = 1 << 24
BLOCKS = (512, 4096)  # the least and the largest block
_BLOCKS_WANTED = 512
BYTES_PER_FILE = 48 << 20
LEAST_BYTES_PER_FILE = 4 << 20
_TEXTS_AT_ONCE = 1000
_HEAD = struct.Struct("<QIIII")


def block_length(ids: int) -> int:
    """Longer blocks code better; a small chunk has shorter ones, to have enough of them."""
    length = BLOCKS[0]
    while length < BLOCKS[1] and ids >= 2 * length * _BLOCKS_WANTED:
        length *= 2
    return length


def _crcs(ids: np.ndarray, length: int) -> np.ndarray:
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    step = 4 * length
    found = [zlib.crc32(raw[k : k + step]) for k in range(0, len(raw), step)]
    return np.array(found, "<u4")


def write_chunk(ids: np.ndarray, pieces: list[tuple[int | None, int, bool]]) -> Iterator[bytes]:
    """A chunk's head and blocks. ``pieces``: document, its ids here, whether it ends here."""
    counts = np.bincount(ids)
    order = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    if len(order) > mixing.MOST_RANKS:
        # More kinds of ids than there are ranks: two chunks.
        half = len(ids) // 2
        left, right, before = [], [], 0
        for document, n, ends in pieces:
            here = min(max(half - before, 0), n)
            if here:
                left.append((document, here, ends and here == n))
            if here < n:
                right.append((document, n - here, ends))
            before += n
        yield from write_chunk(ids[:half], left)
        yield from write_chunk(ids[half:], right)
        return
    rank_of = np.zeros(len(counts), np.uint16)
    rank_of[order] = np.arange(1, len(order) + 1)
    length = block_length(len(ids))
    blocks = math.ceil(len(ids) / length)
    ranks = np.ones(blocks * length, np.uint16)  # the last block is filled up
    ranks[: len(ids)] = rank_of[ids]
    coded = mixing.encode(ranks.reshape(blocks, length))
    sizes = np.fromiter(map(len, coded), "<u4", blocks)
    sums = np.fromiter(map(zlib.crc32, coded), "<u4", blocks)
    head = _HEAD.pack(len(ids), length, blocks, len(order), len(pieces))
    arrays = [
        order.astype("<u4"),
        sizes,
        sums,
        _crcs(ids, length),
        np.array([x or 0 for x, _, _ in pieces], "<i8"),
        np.array([n for _, n, _ in pieces], "<i8"),
        np.array([x is not None for x, _, _ in pieces], "u1"),
        np.array([ends for _, _, ends in pieces], "u1"),
    ]
    head = zlib.compress(head + b"".join(x.tobytes() for x in arrays), 1)
    yield CHUNK + struct.pack("<II", len(head), zlib.crc32(head)) + head
    yield b"".join(coded)


def _exactly(source, n: int) -> bytes:
    data = source.read(n)
    if len(data) != n:
        raise ValueError("a file of ids ends too early")
    return data


def read_chunks(source) -> Iterator[tuple[np.ndarray, list[tuple[int | None, int, bool]]]]:
    """The ids of each chunk of an open file, and its pieces of documents."""
    if _exactly(source, len(MAGIC)) != MAGIC:
        raise ValueError("not a file of ids")
    documents = total = 0
    while (kind := _exactly(source, 4)) == CHUNK:
        size, crc = struct.unpack("<II", _exactly(source, 8))
        head = _exactly(source, size)
        if zlib.crc32(head) != crc:
            raise ValueError("the head of a chunk is damaged")
        head = zlib.decompress(head)
        n, length, blocks, ranks, n_pieces = _HEAD.unpack_from(head)
        at = _HEAD.size

        def array(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(head, kind, count, at)
            at += found.nbytes
            return found

        order = array("<u4", ranks)
        sizes, sums, id_sums = (array("<u4", blocks) for _ in range(3))
        names, counts = array("<i8", n_pieces).tolist(), array("<i8", n_pieces).tolist()
        named, ends = array("u1", n_pieces).tolist(), array("u1", n_pieces).tolist()
        coded = [_exactly(source, size) for size in sizes.tolist()]
        ids = decode_blocks(coded, sums, order, length)[:n]
        if not np.array_equal(_crcs(ids, length), id_sums):
            raise ValueError("decoded ids differ from those that were written")
        pieces = [(x if y else None, c, bool(e)) for x, y, c, e in zip(names, named, counts, ends)]
        documents += sum(ends)
        total += n
        yield ids, pieces
    if kind != DONE or struct.unpack("<QQ", _exactly(source, 16)) != (documents, total):
        raise ValueError("a file of ids does not end as it should")


def decode_blocks(coded: list[bytes], sums: np.ndarray, order: np.ndarray, length: int):
    """The ids of blocks, one after the other; the ids by rank are in the chunk's head."""
    if [zlib.crc32(x) for x in coded] != sums.tolist():
        raise ValueError("a block is damaged")
    by_rank = np.concatenate([np.zeros(1, np.uint32), order]).astype(np.uint32)
    return by_rank[mixing.decode(coded, length).reshape(-1)]


class _Writer:
    """Gathers the ids of documents and writes a chunk when there are enough."""

    def __init__(self, sink):
        self.sink = sink
        self.ids = np.empty(BLOCKS[0], np.uint32)
        self.used = 0
        self.pieces: list[tuple] = []
        self.documents = self.total = self.size = 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.sink.write(data)
        self.size += len(data)

    def add(self, document: int | None, ids: np.ndarray) -> None:
        self.documents += 1
        self.total += len(ids)
        while True:
            some = ids[: CHUNK_IDS - self.used]
            ids = ids[len(some) :]
            while self.used + len(some) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[self.used : self.used + len(some)] = some
            self.used += len(some)
            self.pieces.append((document, len(some), not len(ids)))
            if not len(ids):
                break
            self._chunk()
        if self.used >= CHUNK_IDS:
            self._chunk()

    def _chunk(self) -> None:
        for part in write_chunk(self.ids[: self.used], self.pieces):
            self._write(part)
        self.used, self.pieces = 0, []

    def close(self) -> None:
        if self.pieces:
            self._chunk()
        self._write(DONE + struct.pack("<QQ", self.documents, self.total))


FILES = "number int, file string, n_documents long, n_ids long, bytes long"


def write_files(
    documents: DataFrame,
    tokenizer_path: str,
    scratch: Scratch,
    end_id: int = END,
    bytes_per_file: int = BYTES_PER_FILE,
) -> DataFrame:
    """Encodes whole texts, ends each with ``end_id``, and writes them by rising ``doc_id``.

    Null texts are empty and have the end id alone; documents without id come first; rows that
    share an id are documents of their own, in an order set by their texts. Other columns are not
    read. One row per file: its number in the order of the ids, name in the folder ``ids`` of
    ``scratch``, documents, ids and bytes.
    """
    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    cores = chosen.sparkSession.sparkContext.defaultParallelism
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(
        math.ceil(size / bytes_per_file),
        min(cores, math.ceil(size / LEAST_BYTES_PER_FILE)),
        1,
    )
    root = scratch.path("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, context = unit_ids(tokenizer_path), TaskContext.get()
        system, folder = fs.FileSystem.from_uri(root)
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}.ids"
        system.create_dir(folder, recursive=True)
        writer = None
        with system.open_output_stream(f"{folder}/{name}") as sink:
            writer = _Writer(sink)
            for batch in batches:
                for first in range(0, len(batch), _TEXTS_AT_ONCE):
                    some = batch.slice(first, _TEXTS_AT_ONCE)
                    for document, ids in zip(some[0].to_pylist(), units.encode(some[1])):
                        writer.add(document, np.append(ids, np.uint32(end_id)))
            writer.close()
        rows = [context.partitionId()], [name], [writer.documents], [writer.total], [writer.size]
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        columns = [pa.array(x, k) for x, k in zip(rows, kinds)]
        names = [x.split()[0] for x in FILES.split(", ")]
        yield pa.RecordBatch.from_arrays(columns, names)

    # Rows without id may be many: the text spreads them.
    place = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = chosen.repartitionByRange(files, *place).sortWithinPartitions(*place)
    return scratch.store(dealt.mapInArrow(run, FILES), "files")


DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_files(files: DataFrame, root: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the listed files in the folder ``root``: ``doc_id``, ``start`` (the
    ids of all documents before it), ``n_tokens``, ``ids_crc32`` of its ids as little-endian
    numbers of 32 bits and, if wanted, the ids themselves.

    A damaged head or block, or a file cut short, fails the read.
    """
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    based = files.select(  # one row per file
        "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")
    )
    schema = DOCUMENTS + (", ids array<int>" if with_ids else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64()] * 4 + ([pa.list_(pa.int32())] if with_ids else [])

    def documents_in(source, start: int) -> Iterator[tuple]:
        crc, n, parts = 0, 0, []
        for ids, pieces in read_chunks(source):
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            at = 0
            for document, count, ends in pieces:
                crc = zlib.crc32(raw[4 * at : 4 * (at + count)], crc)
                if with_ids:
                    parts.append(ids[at : at + count])
                n += count
                at += count
                if ends:
                    row = (document, start, n, crc)
                    yield (*row, np.concatenate(parts)) if with_ids else row
                    start += n
                    crc, n, parts = 0, 0, []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for file, start in zip(batch[0].to_pylist(), batch[1].to_pylist()):
                rows, size = [], 0
                with system.open_input_stream(f"{folder}/{file}") as source:
                    for row in documents_in(source, start):
                        rows.append(row)
                        size += 1 + (row[2] if with_ids else 0)
                        if len(rows) == 4096 or size > 1 << 20:
                            columns = [pa.array(x, k) for x, k in zip(zip(*rows), kinds)]
                            yield pa.RecordBatch.from_arrays(columns, names)
                            rows, size = [], 0
                if rows:
                    columns = [pa.array(x, k) for x, k in zip(zip(*rows), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    # Dealt out in turn: a task has one file.
    dealt = based.repartition(max(1, files.count()))
    return dealt.mapInArrow(run, schema)


def round_trip(documents: DataFrame, tokenizer_path: str, end_id: int = END) -> DataFrame:
    """Documents written to files of ids and read back from them, one row per document."""
    scratch = Scratch(documents.sparkSession, "token-files")
    files = write_files(documents, tokenizer_path, scratch, end_id)
    return read_files(files, scratch.path("ids"))
