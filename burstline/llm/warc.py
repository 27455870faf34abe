"""WARC archives: one gzip member per record, written by tasks, read back in byte ranges.

Reading is splittable. A task scans its range for the first bytes of a gzip member, takes a
candidate only if it decodes to a record header, and owns the records that start inside the
range; it follows the last one beyond the range's end. So every record is read once, wherever the
ranges are cut.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.storage import Scratch, values

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = b"WARC/1."
_HTTP = "application/http"
_PAGE = re.compile(r"<?urn:page:(-?[0-9]+)>?")
FOREIGN, DAMAGED = "foreign", "damaged"
RECORD_DATE = "2024-01-01T00:00:00Z"

SPLIT_BYTES = 8 << 20
LEAST_REVISITED = 100
_READ = 1 << 18
_GZIP = 31


def _header_safe(text: str | None) -> str:
    """Percent-encodes what would end a header line."""
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in text or "")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """A response record with the payload, or a revisit record without."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Target-URI: {_header_safe(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, _GZIP)
    return packer.compress(data) + packer.flush()


def with_revisits(
    pages: DataFrame, scratch: Scratch, least: int = LEAST_REVISITED
) -> DataFrame:
    """``page_id``, ``url``, payload and its digest, and the page that a revisit refers to: the
    smallest id of the rows whose payloads of ``least`` bytes or more are equal.

    Digests that occur once are not kept, and the others are stored first, so Spark knows their
    size: it broadcasts few and shuffles many, splitting hot ones.
    """
    keyed = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= least
    repeated = (
        keyed.filter(long_enough)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter(F.col("n") > 1)
        .select(F.col("digest").alias("_digest"), "first")
    )
    repeated = scratch.store(repeated, "repeated")
    same = (F.col("digest") == F.col("_digest")) & long_enough
    refers = F.when(F.col("page_id") != F.col("first"), F.col("first"))
    return keyed.join(repeated, same, "left").select(
        "page_id", "url", "payload", "digest", refers.alias("refers_to")
    )


def write_archive(pages: DataFrame, scratch: Scratch, name: str = "archive") -> DataFrame:
    """Writes all pages as records and returns the list of files: ``file``, ``bytes``.

    Each task writes a file of its own attempt, and only files of attempts that ended well are on
    the list, so a lost or repeated task leaves no record twice.
    """
    root = scratch.path(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        system, folder = fs.FileSystem.from_uri(root)
        system.create_dir(folder, recursive=True)
        file = f"part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.gz"
        size = 0
        with system.open_output_stream(f"{folder}/{file}", compression=None) as out:
            for batch in batches:
                for row in zip(*(values(c) for c in batch.columns)):
                    data = member(record(*row))
                    out.write(data)
                    size += len(data)
        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([size])], ["file", "bytes"])

    return scratch.store(with_revisits(pages, scratch).mapInArrow(run, "file string, bytes long"), "files")


class _Window:
    """Bytes of a file from any position on, read ahead in steps and dropped once passed."""

    def __init__(self, source, size: int):
        self.source, self.size, self.start, self.data = source, size, 0, b""

    def at(self, position: int, n: int) -> bytes:
        """``n`` bytes, fewer at the end of the file."""
        n = min(n, self.size - position)
        if position < self.start or position + n > self.start + len(self.data):
            self.source.seek(position)
            self.start, self.data = position, self.source.read(max(n, _READ))
        first = position - self.start
        return self.data[first : first + n]


def _member_at(window: _Window, position: int) -> Iterator[bytes | int]:
    """The decoded pieces of a member, then its length in the file."""
    unpacker, read = zlib.decompressobj(_GZIP), 0
    while not unpacker.eof:
        piece = window.at(position + read, 1 << 16)
        if not piece:
            raise zlib.error("the file ends inside a member")
        yield unpacker.decompress(piece)
        read += len(piece) - len(unpacker.unused_data)
    yield read


def _until_blank_line(data: bytes, pieces: Iterator) -> tuple[bytes, bytes, int | None]:
    """Header and what has been decoded after it; the member's length if it has ended."""
    held, searched = bytearray(data), 0
    while (end := held.find(b"\r\n\r\n", searched)) < 0:
        searched = max(0, len(held) - 3)
        piece = next(pieces)
        if isinstance(piece, int):
            raise zlib.error("no end of header")
        held += piece
    return bytes(held[:end]), bytes(held[end + 4 :]), None


def _fields(header: bytes) -> dict[str, str]:
    """Names in lower case and values; a line that begins with white space goes on the last one."""
    found: dict[str, str] = {}
    last = None
    for line in header.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last is not None:
            found[last] = f"{found[last]} {line.strip()}"
            continue
        name, _, value = line.partition(":")
        last = name.strip().lower()
        found.setdefault(last, value.strip())
    return found


def _page_of(urn: str | None) -> int | None:
    """The number in a page's own urn; other ids are text only."""
    found = _PAGE.fullmatch(urn or "")
    return int(found[1]) if found else None


def _number(text: str | None) -> int | None:
    return int(text) if text is not None and text.isascii() and text.isdigit() else None


def _digest_named(text: str | None) -> str | None:
    """A digest as a record names it: sha256 bare, others with the name of their kind."""
    return text.removeprefix("sha256:") if text else None


def read_record(window: _Window, position: int) -> tuple[dict, int] | None:
    """The record that starts here and its length in the file; None if none does.

    All versions 1 and all types of records are read. The payload of an HTTP response is what
    follows its header, as it was sent; of other records it is the whole block. A revisit has no
    payload: length and digest are those it names, if it does. A member that is whole but no
    record is given as one of type ``foreign``, with nothing else.
    """
    try:
        pieces = _member_at(window, position)
        data = b""
        while len(data) < len(VERSIONS):
            piece = next(pieces)
            if isinstance(piece, int):
                return _nothing(FOREIGN), piece
            data += piece
        if not data.startswith(VERSIONS):
            return _nothing(FOREIGN), next(x for x in pieces if isinstance(x, int))
        header, rest, _ = _until_blank_line(data, pieces)
        fields = _fields(header)
        kind, left = fields["warc-type"].lower(), int(fields["content-length"])
        http: dict[str, str] = {}
        is_http = fields.get("content-type", "").replace(" ", "").lower().startswith(_HTTP)
        if kind in ("response", "revisit") and is_http and left:
            head, rest, after = _http_header(rest, pieces, left)
            left -= after
            http = _fields(head)
        digest, payload_bytes, length = hashlib.sha256(), left, 0
        digest.update(rest[:left])
        left -= len(rest[:left])
        for piece in pieces:
            if isinstance(piece, int):
                length = piece
                break
            digest.update(piece[:left])
            left -= len(piece[:left])
        if left:
            return None  # the member ends inside the block
    except (zlib.error, KeyError, ValueError, StopIteration):
        return None
    revisit = kind == "revisit"
    found = _nothing(kind) | {
        "page_id": _page_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": _number(http.get("content-length")) if revisit else payload_bytes,
        "payload_digest": (
            _digest_named(fields.get("warc-payload-digest")) if revisit else digest.hexdigest()
        ),
        "refers_to": _page_of(fields.get("warc-refers-to")) if revisit else None,
        "record_id": fields.get("warc-record-id"),
        "refers_to_id": fields.get("warc-refers-to"),
    }
    return found, length


def _nothing(kind: str) -> dict:
    return dict.fromkeys(_RECORD.names) | {"record_type": kind}


def _http_header(rest: bytes, pieces: Iterator, size: int) -> tuple[bytes, bytes, int]:
    """Header of an HTTP message in a block, what has been decoded after it, and how many bytes
    the header takes. A block without a blank line is all payload."""
    held, searched = bytearray(rest), 0
    while (end := held.find(b"\r\n\r\n", searched, size)) < 0:
        if len(held) >= size:
            return b"", bytes(held), 0
        searched = max(0, len(held) - 3)
        piece = next(pieces)
        if isinstance(piece, int):
            raise zlib.error("the member ends inside its block")
        held += piece
    return bytes(held[:end]), bytes(held[end + 4 :]), end + 4


def records_in(window: _Window, start: int, end: int) -> Iterator[dict]:
    """The records that start in a byte range. Bytes where a record has to start and none does are
    given as one of type ``damaged``; the next record is looked for behind them."""
    position, expected = start, start == 0
    while position < end:
        found = read_record(window, position) if window.at(position, 3) == MAGIC else None
        if found:
            yield found[0]
            position, expected = position + found[1], True
            continue
        if expected:
            yield _nothing(DAMAGED)
            expected = False
        position += 1
        while position < end:  # to the next candidate
            ahead = window.at(position, min(_READ, end - position + 2))
            k = ahead.find(MAGIC)
            if k >= 0:
                position += k
                break
            position += max(1, len(ahead) - 2)


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("record_id", pa.string()),
        ("refers_to_id", pa.string()),
    ]
)
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, record_id string, refers_to_id string"
)


def read_archive(files: DataFrame, root: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """All records of the listed files (``file``, ``bytes``) in the folder ``root``: one row each,
    payloads digested as they stream by.

    Archives of other writers are read too, a gzip member per record. ``page_id`` and
    ``refers_to`` are for ids that this library writes; ``record_id`` and ``refers_to_id`` are as
    they stand. Members that are no records, and bytes that are no members, are rows of their own
    (types ``foreign`` and ``damaged``), so nothing is passed over without a trace.
    """
    ranges = files.filter(F.col("bytes") > 0).select(
        "file",
        "bytes",
        F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            for file, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{folder}/{file}") as source:
                    rows = []
                    for found in records_in(
                        _Window(source, size), start, min(size, start + split_bytes)
                    ):
                        rows.append(found)
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows = []
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)

    total = files.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(1, math.ceil(total / split_bytes))
    dealt = ranges.repartition(tasks, F.col("file"), F.col("start"))
    return dealt.select("file", "bytes", "start").mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Pages written as an archive and read back, one row per page row.

    Null html and null urls are empty; a null ``page_id`` comes back null and is never referred
    to while another id has the payload; rows that share id and payload are responses both.
    Other columns are not archived.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    files = write_archive(pages, scratch)
    read = read_archive(files, scratch.path("archive"), split_bytes)
    return read.drop("record_id", "refers_to_id")
