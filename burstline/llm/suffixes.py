"""Removal of repeated passages by merging Burrows-Wheeler transforms of shards.

A byte is removed if a string of ``least`` bytes that covers it also starts earlier. Three steps
make the text that has to be sorted small, without losing a repeat:

1. Of each window of ``least`` bytes the least of its 32-byte strings by hash is its anchor. Equal
   windows have equal anchors at equal places, so only windows with a repeated anchor matter.
   Neighbouring windows of one anchor are a segment.
2. Segments equal in anchor and content are repeats of the first of them, as a whole. Tasks
   settle their own first, so a passage found everywhere goes on once per task.
3. Segments that share an anchor but differ are put in bins by anchor. In a bin they are shards:
   each has its Burrows-Wheeler transform, the transforms are merged by refining their interleave
   symbol by symbol, and the refinement tells which windows are equal (common prefixes of
   ``least`` bytes). A symbol is ten or five bytes. Suffixes are sorted within shards only.

An anchor may be in a passage that very many documents hold, each continuing otherwise. Such
segments are parted by longer anchors first, as step 1 parts texts: equal windows have equal ones
of any length. Parts of equal content are repeats of the first of them, parts whose longer anchor
is nowhere else repeat nothing, and only the others go on, to bins or to still longer anchors, at
last as long as a window. So a bin is small however often an anchor occurs, and segments are not
compared pair by pair. Texts are taken whole, as UTF-8 bytes, and matches never cross documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.storage import Scratch, unused, values

LEAST = 100
ANCHOR = 32
CHUNK = 1 << 19  # windows of a long text taken at a time
FLUSH = 1_000_000  # anchors that a task gathers before it settles them
BYTES_PER_SHARD = 24 << 20  # of text, in step 2
SEGMENTS_PER_BIN = 1000  # an anchor of more is parted by longer ones
SEGMENTS_PER_SHARD = 1000
_SHARDS_AT_ONCE = 64
_PIECES_AT_ONCE = 4000
HOT = 64  # segments of one anchor in one task from which on they are dealt out
_MOST_SYMBOLS = 1 << 16
_NO_ID = -(2**63)
_PLACE_BITS = np.uint64(20)
_BASE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of each string of so many bytes."""
    part, size, hashes, have = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if width & size:
            count = len(data) - have - size + 1
            if hashes is None:
                hashes = part
            else:
                hashes = hashes[:count] * np.uint64(pow(_BASE, size, 2**64)) + part[have:]
            have += size
        if have == width:
            return _mixed(hashes)
        part = part[:-size] * np.uint64(pow(_BASE, size, 2**64)) + part[size:]
        size *= 2


def _places(data: np.ndarray, least: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each string of ``width`` bytes, and of each window the place of the least of its
    own; of equal ones the leftmost, so the choice depends on the window alone."""
    hashes = _hashed(data, width)
    ranked = (hashes >> _PLACE_BITS) << _PLACE_BITS
    low = ranked | np.arange(len(hashes), dtype=np.uint64)
    reach, spread = 1, least - width + 1
    while 2 * reach <= spread:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if spread > reach:
        low = np.minimum(low[: reach - spread], low[spread - reach :])
    return hashes, (low & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)


def segments(data: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """Anchor hash, first window and number of windows of each segment, fewer than 2^20 bytes."""
    if len(data) < least:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes, place = _places(data, least, ANCHOR)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return hashes[place[first]], first, np.diff(first, append=len(place))


def parted(pieces: list[bytes], least: int, width: int) -> tuple[np.ndarray, ...]:
    """The same for each of several pieces by anchors of ``width`` bytes, with the numbers of the
    pieces in front; all together fewer than 2^20 bytes, each of ``least`` bytes or more."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    hashes, place = _places(data, least, width)
    windows, begin = lengths - least + 1, np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(pieces)), windows)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = place[begin[owner] + inside]
    new = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    first = np.flatnonzero(np.concatenate([[True], new]))
    sizes = np.diff(first, append=len(place))
    return owner[first], hashes[place[first]], inside[first], sizes


def merged_ranges(owner: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of each owner, those that overlap or touch as one."""
    if not len(owner):
        return owner, start, stop
    order = np.lexsort((start, owner))
    owner, start, stop = owner[order], start[order], stop[order]
    new = np.concatenate([[True], owner[1:] != owner[:-1]])
    group = np.cumsum(new) - 1
    wide = int(stop.max()) + 1
    reached = np.maximum.accumulate(stop + group * wide) - group * wide
    new[1:] |= start[1:] > reached[:-1]
    at = np.flatnonzero(new)
    return owner[at], start[at], np.maximum.reduceat(stop, at)


def _settled(anchor, content, rank, start, length, hot):
    """Which segments are the first of their content, which come after an equal one, and which
    of the first share their anchor with another."""
    order = np.lexsort((start, rank, content, anchor))
    a, c = anchor[order], content[order]
    new_a = np.concatenate([[True], a[1:] != a[:-1]])
    new = new_a | np.concatenate([[True], c[1:] != c[:-1]])
    first = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = (rank[order] != rank[first]) | (start[order] != start[first])
    group = np.cumsum(new_a) - 1
    kinds = np.bincount(group, new)
    known_hot = np.bincount(group, hot[order]) > 0
    shared = (kinds > 1) | known_hot
    return order[new], order[later], order[new & shared[group]], np.bincount(group, new)[group[new]]


def _ranks(ids: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """The place of each document in the order of ids, equal documents alike."""
    order = np.lexsort((prints, ids))
    new = (np.diff(ids[order]) != 0) | (np.diff(prints[order]) != 0)
    out = np.empty(len(ids), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(new)]) if len(ids) else []
    return out


_ARRAYS = {
    "ids": np.int64,
    "prints": np.int64,
    "doc": np.uint32,
    "anchor": np.uint64,
    "content": np.uint64,
    "start": np.int64,
    "length": np.uint8,
    "hot": np.bool_,
    "gone_doc": np.uint32,
    "gone_start": np.int64,
    "gone_stop": np.int64,
}
_SHIPPED = "shard int, " + ", ".join(f"{name} binary" for name in _ARRAYS)


class _Gathered:
    """Segments of the documents of one task."""

    def __init__(self, shards: int, least: int):
        self.shards, self.least = shards, least
        self._empty()

    def _empty(self) -> None:
        self.ids, self.prints, self.parts, self.count = [], [], [], 0

    def add(self, doc_id: int | None, fingerprint: int, text: bytes) -> None:
        import xxhash

        digest, doc = xxhash.xxh3_64_intdigest, len(self.ids)
        data = np.frombuffer(text, np.uint8)
        more = self.least - 1
        for begin in range(0, max(len(data) - more, 0), CHUNK):
            anchor, first, windows = segments(data[begin : begin + CHUNK + more], self.least)
            if not len(first):
                continue
            first = first + begin
            stops = (first + windows + more).tolist()
            content = [digest(text[a:b]) for a, b in zip(first.tolist(), stops)]
            own = np.full(len(first), doc)
            self.parts.append((own, anchor, np.array(content, np.uint64), first, windows))
            self.count += len(first)
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.prints.append(fingerprint)

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What goes to each shard, one row per shard that gets something; ranges that are settled
        here go along with some of them. Takes time by what was gathered, not by the shards."""
        if not self.parts:
            self._empty()
            return
        doc, anchor, content, start, length = (np.concatenate(x) for x in zip(*self.parts))
        ids, prints = np.array(self.ids, np.int64), np.array(self.prints, np.int64)
        hot = np.zeros(len(doc), bool)
        first, later, _, kinds = _settled(
            anchor, content, _ranks(ids, prints)[doc], start, length, hot
        )
        gone = merged_ranges(doc[later], start[later], start[later] + length[later] + self.least - 1)
        doc, anchor, content = doc[first], anchor[first], content[first]
        start, length, hot = start[first], length[first], kinds >= HOT
        to = anchor % np.uint64(self.shards)
        # Hot ones are dealt out by content, but one that tells the anchor's own shard.
        tells = hot & np.concatenate([[True], anchor[1:] != anchor[:-1]])
        to = np.where(hot & ~tells, content % np.uint64(self.shards), to).astype(np.int64)
        own = np.argsort(to, kind="stable")
        gone_to = gone[0].astype(np.int64) % self.shards
        lost = np.argsort(gone_to, kind="stable")
        to, gone_to = to[own], gone_to[lost]
        # A shard's documents, each once, in front of what names them.
        pairs = np.concatenate([to, gone_to]) * len(ids)
        pairs = pairs + np.concatenate([doc[own], gone[0][lost]])
        known, at = np.unique(pairs, return_inverse=True)
        shard_of, docs = np.divmod(known, len(ids))
        shards, begin = np.unique(shard_of, return_index=True)
        at = at - begin[np.searchsorted(shards, np.concatenate([to, gone_to]))]
        columns = {
            "ids": (shard_of, ids[docs]),
            "prints": (shard_of, prints[docs]),
            "doc": (to, at[: len(own)]),
            "anchor": (to, anchor[own]),
            "content": (to, content[own]),
            "start": (to, start[own]),
            "length": (to, length[own]),
            "hot": (to, hot[own]),
            "gone_doc": (gone_to, at[len(own) :]),
            "gone_start": (gone_to, gone[1][lost]),
            "gone_stop": (gone_to, gone[2][lost]),
        }
        edges = np.append(shards, self.shards)
        arrays = [pa.array(shards.astype(np.int32))]
        for name, (of, column) in columns.items():
            packed = np.ascontiguousarray(column).astype(_ARRAYS[name])
            cuts = (np.searchsorted(of, edges) * packed.itemsize).astype(np.int32)
            buffers = [None, pa.py_buffer(cuts), pa.py_buffer(packed)]
            arrays.append(pa.BinaryArray.from_buffers(pa.binary(), len(shards), buffers))
        whole = pa.RecordBatch.from_arrays(arrays, ["shard", *_ARRAYS])
        for k in range(0, len(shards), _SHARDS_AT_ONCE):
            yield whole.slice(k, _SHARDS_AT_ONCE)
        self._empty()


_FOUND = "doc_id long, print long, start long, stop long, anchor long"


def _found(texts: DataFrame, shards: int, least: int) -> DataFrame:
    """Ranges of repeated segments (``anchor`` null) and segments that share an anchor."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = _Gathered(shards, least)
        for batch in batches:
            for row in zip(*(values(c) for c in batch.columns)):
                gathered.add(*row)
                if gathered.count >= FLUSH:
                    yield from gathered.rows()
        yield from gathered.rows()

    def settle(table: pa.Table) -> pa.Table:
        arrays = {k: [] for k in _ARRAYS}
        docs = 0
        for row in table.to_pylist():
            for k, kind in _ARRAYS.items():
                array = np.frombuffer(row[k], kind)
                arrays[k].append(array.astype(np.int64) + docs if k in ("doc", "gone_doc") else array)
            docs += len(arrays["ids"][-1])
        x = {k: np.concatenate(v) for k, v in arrays.items()}
        length = x["length"].astype(np.int64)
        rank = _ranks(x["ids"], x["prints"])
        owner, start, stop = x["gone_doc"], x["gone_start"], x["gone_stop"]
        shared = np.zeros(0, np.int64)
        if len(length):
            _, later, shared, _ = _settled(
                x["anchor"], x["content"], rank[x["doc"]], x["start"], length, x["hot"]
            )
            owner = np.concatenate([owner, x["doc"][later]])
            start = np.concatenate([start, x["start"][later]])
            stop = np.concatenate([stop, x["start"][later] + length[later] + least - 1])
        owner, start, stop = merged_ranges(owner, start, stop)
        docs = np.concatenate([owner, x["doc"][shared]])
        start = np.concatenate([start, x["start"][shared]])
        stop = np.concatenate([stop, x["start"][shared] + length[shared] + least - 1])
        none = np.arange(len(docs)) < len(owner)
        anchor = np.concatenate([np.zeros(len(owner), np.uint64), x["anchor"][shared]])
        return pa.table(
            {
                "doc_id": pa.array(x["ids"][docs]),
                "print": pa.array(x["prints"][docs]),
                "start": pa.array(start),
                "stop": pa.array(stop),
                "anchor": pa.array(anchor.view(np.int64), mask=none),
            }
        )

    return texts.mapInArrow(gather, _SHIPPED).groupBy("shard").applyInArrow(settle, _FOUND)


class Transform:
    """The Burrows-Wheeler transform of a shard, read as a circle, in symbols of several bytes:
    before each suffix in sorted order stands a symbol, and taking that symbol in front leads to
    another suffix."""

    def __init__(self, text: bytes):
        data = np.frombuffer(text, np.uint8)
        n = len(data)
        place = np.arange(n)
        eight = np.zeros(n, np.uint64)
        for k in range(8):
            eight = (eight << np.uint64(8)) | data[(place + k) % n]
        width, rank = 8, _dense(eight)
        while width < LEAST and rank.max() < n - 1:
            rank = _dense(rank * n + rank[(place + width) % n])
            width *= 2
        self.data, self.n = data, n
        self.suffixes = np.argsort(rank, kind="stable")
        self.ranks = np.empty(n, np.int64)
        self.ranks[self.suffixes] = place

    def symbols(self, width: int) -> np.ndarray:
        """What stands before each suffix, up to five bytes as a number."""
        out = np.zeros(self.n, np.uint64)
        for k in range(width, 0, -1):
            out = (out << np.uint64(8)) | self.data[(self.suffixes - k) % self.n]
        return out

    def steps(self, width: int) -> np.ndarray:
        """The suffix, by its number, that begins ``width`` bytes earlier."""
        return self.ranks[(self.suffixes - width) % self.n]


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    new = np.concatenate([[0], np.cumsum(np.diff(keys[order]) != 0)])
    out = np.empty(len(keys), np.int64)
    out[order] = new
    return out


def merge(shards: list[Transform], least: int = LEAST) -> list[np.ndarray]:
    """Of each shard, by position in its text, a number that tells the ``least`` bytes there:
    equal numbers, equal bytes, also across shards.

    The interleave of the sorted suffixes begins as one shard after the other. A round puts a
    symbol in front of every suffix: it deals the interleave out by symbols, each keeping the
    order it has, and moves every entry to the suffix it has become. After k rounds the interleave
    is in the order of the first k symbols, and a mark stands wherever they change.
    """
    width = math.gcd(5, least)
    offsets = np.cumsum([0, *(x.n for x in shards)])
    symbols = _dense(np.concatenate([x.symbols(width) for x in shards]))
    steps = np.concatenate([x.steps(width) + o for x, o in zip(shards, offsets)])
    if least % (2 * width) == 0:  # two symbols as one: the one before, then this
        double = _dense(symbols[steps] * (int(symbols.max()) + 1) + symbols)
        if double.max() < _MOST_SYMBOLS:
            symbols, steps, width = double, steps[steps], 2 * width
    symbols = symbols.astype(np.uint16 if symbols.max() < _MOST_SYMBOLS else np.uint32)
    steps = steps.astype(np.int32)
    interleave = np.arange(len(steps), dtype=np.int32)
    group = np.zeros(len(steps), np.int32)
    for _ in range(least // width):
        dealt = np.argsort(symbols[interleave], kind="stable")
        entries, group = interleave[dealt], group[dealt]
        symbol = symbols[entries]
        mark = (symbol[1:] != symbol[:-1]) | (group[1:] != group[:-1])
        group = np.concatenate([[0], np.cumsum(mark, dtype=np.int32)]).astype(np.int32)
        interleave = steps[entries]
    by_entry = np.empty(len(steps), np.int64)
    by_entry[interleave] = group
    out = []
    for shard, offset in zip(shards, offsets):
        by_position = np.empty(shard.n, np.int64)
        by_position[shard.suffixes] = by_entry[offset : offset + shard.n]
        out.append(by_position)
    return out


def repeats(pieces: list[list[bytes]], ranks: list[np.ndarray], starts: list[np.ndarray], least: int):
    """Of segments in shards, the ranges that repeat something earlier: (shard, segment, start,
    stop), places counted in the document. ``ranks`` order the documents."""
    kept = [k for k, own in enumerate(pieces) if own]
    merged = merge([Transform(b"".join(pieces[k])) for k in kept], least)
    numbers, order, place, where = [], [], [], []
    for k, by_position in zip(kept, merged):
        lengths = np.fromiter(map(len, pieces[k]), np.int64, len(pieces[k]))
        windows = lengths - least + 1
        segment = np.repeat(np.arange(len(lengths)), windows)
        inside = np.arange(len(segment)) - np.repeat(np.cumsum(windows) - windows, windows)
        numbers.append(by_position[(np.cumsum(lengths) - lengths)[segment] + inside])
        order.append(ranks[k][segment])
        place.append(starts[k][segment] + inside)
        where.append(np.stack([np.full(len(segment), k), segment], 1))
    number, rank, start = (np.concatenate(x) for x in (numbers, order, place))
    where = np.concatenate(where)
    by_number = np.lexsort((start, rank, number))
    n = number[by_number]
    new = np.concatenate([[True], n[1:] != n[:-1]])
    first = by_number[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = by_number[(rank[by_number] != rank[first]) | (start[by_number] != start[first])]
    owner = where[later, 0] * (int(where[:, 1].max()) + 1) + where[later, 1]
    owner, begin, end = merged_ranges(owner, start[later], start[later] + least)
    shard, segment = np.divmod(owner, int(where[:, 1].max()) + 1)
    return shard, segment, begin, end


_PIECES = "anchor long, doc_id long, print long, start long, piece binary"
_PARTS = "content long, " + _PIECES
_RANGES = "doc_id long, print long, start long, stop long"


def _pieces(texts: DataFrame, shared: DataFrame) -> DataFrame:
    """Segments that share an anchor, with their bytes."""
    asked = shared.groupBy("doc_id", "print").agg(
        F.collect_list(F.struct("start", "stop", "anchor")).alias("asked")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, fingerprint, text, wanted in zip(*(values(c) for c in batch.columns)):
                for x in wanted:
                    piece = text[x["start"] : x["stop"]]
                    rows.append((x["anchor"], doc_id, fingerprint, x["start"], piece))
                if len(rows) > 20_000:
                    yield _batch(rows, _PIECES)
                    rows = []
            if rows:
                yield _batch(rows, _PIECES)

    joined = texts.withColumn("doc_id", F.coalesce("doc_id", F.lit(_NO_ID))).join(asked, ["doc_id", "print"])
    return joined.select("doc_id", "print", "text", "asked").mapInArrow(cut, _PIECES)


def _parts(pieces: DataFrame, least: int, width: int) -> DataFrame:
    """Pieces parted by anchors of ``width`` bytes."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for k in range(0, batch.num_rows, _PIECES_AT_ONCE):
                some = batch.slice(k, _PIECES_AT_ONCE)
                ids, prints, starts, data = (c.to_pylist() for c in some.columns)
                own, anchor, first, windows = parted(data, least, width)
                found = zip(own.tolist(), anchor.view(np.int64).tolist(), first.tolist(), windows.tolist())
                rows = []
                for own, anchor, first, windows in found:
                    piece = data[own][first : first + windows + least - 1]
                    content = xxhash.xxh3_64_intdigest(piece) - 2**63
                    rows.append((content, anchor, ids[own], prints[own], starts[own] + first, piece))
                yield _batch(rows, _PARTS)

    return pieces.select("doc_id", "print", "start", "piece").mapInArrow(part, _PARTS)


def _bounded(scratch: Scratch, pieces: DataFrame, least: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Pieces none of whose anchors more than ``SEGMENTS_PER_BIN`` have, and ranges that repeat
    something earlier in those with an anchor that more had."""
    bounded, ranges, width, level = [], [], ANCHOR, 0
    while True:
        often = pieces.groupBy("anchor").count().filter(F.col("count") > SEGMENTS_PER_BIN)
        often = scratch.store(often.select("anchor"), f"often{level}")
        if often.isEmpty():
            return [*bounded, pieces], ranges
        bounded.append(pieces.join(often, "anchor", "left_anti"))
        width = least - (least - width) // 4
        parts = _parts(pieces.join(often, "anchor", "left_semi"), least, width)
        parts = scratch.store(parts, f"parts{level}")
        firsts = parts.groupBy("anchor", "content").agg(
            F.min(F.struct("doc_id", "print", "start", "piece")).alias("first")
        )
        firsts = scratch.store(firsts, f"firsts{level}")
        same = parts.withColumn("stop", F.col("start") + F.octet_length("piece")).drop("piece")
        own = F.struct("doc_id", "print", "start")
        told = F.struct("first.doc_id", "first.print", "first.start")
        later = same.join(firsts, ["anchor", "content"]).filter(own != told)
        later = later.select("doc_id", "print", "start", "stop")
        ranges.append(scratch.store(later, f"later{level}"))
        if width == least:  # parts are windows, and equal ones are told
            return bounded, ranges
        others = firsts.groupBy("anchor").count().filter(F.col("count") > 1).select("anchor")
        pieces = firsts.select("anchor", "first.*").join(others, "anchor", "left_semi")
        pieces = scratch.store(pieces, f"pieces{level}")
        level += 1


def _compared(scratch: Scratch, texts: DataFrame, shared: DataFrame, least: int) -> DataFrame:
    """Ranges that repeat something earlier in segments that share an anchor."""
    pieces = scratch.store(_pieces(texts, shared), "pieces")
    scratch.release()
    bounded, ranges = _bounded(scratch, pieces, least)
    scratch.release()
    pieces = reduce(DataFrame.unionByName, bounded)
    bins = max(1, math.ceil(pieces.count() / SEGMENTS_PER_BIN))
    placed = pieces.select(
        F.pmod(F.xxhash64("anchor"), F.lit(bins)).alias("bin"), "doc_id", "print", "start", "piece"
    )

    def compare(table: pa.Table) -> pa.Table:
        ids, prints, starts = (table.column(c).to_numpy() for c in ("doc_id", "print", "start"))
        rank, data = _ranks(ids, prints), table.column("piece").to_pylist()
        # One shard would have nothing to merge.
        blocks = min(max(2, math.ceil(len(data) / SEGMENTS_PER_SHARD)), len(data))
        shards = [np.arange(b, len(data), blocks) for b in range(blocks)]
        shard, segment, begin, end = repeats(
            [[data[k] for k in own] for own in shards],
            [rank[own] for own in shards],
            [starts[own] for own in shards],
            least,
        )
        rows = np.array([shards[a][b] for a, b in zip(shard, segment)], np.int64)
        found = {"doc_id": ids[rows], "print": prints[rows], "start": begin, "stop": end}
        return pa.table({k: pa.array(v, pa.int64()) for k, v in found.items()})

    compared = placed.groupBy("bin").applyInArrow(compare, _RANGES)
    return reduce(DataFrame.union, [compared, *ranges])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    kinds = [pa.binary() if kind == "binary" else pa.int64() for _, kind in fields]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], [name for name, _ in fields]
    )


_RESULT = "struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>"
_ARROW_RESULT = pa.struct(
    [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
)


def _removed(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    out = []
    for text, gone in zip(values(texts), values(ranges)):
        text, kept, done, spans = text or b"", [], 0, 0
        pairs = np.array([(x["start"], x["stop"]) for x in gone or ()], np.int64).reshape(-1, 2)
        _, starts, stops = merged_ranges(np.zeros(len(pairs), np.int64), *pairs.T)
        for a, b in zip(starts.tolist(), stops.tolist()):
            kept.append(text[done:a])
            done, spans = b, spans + 1
        left = b"".join([*kept, text[done:]])
        out.append(
            {"n_bytes": len(text), "n_removed": len(text) - len(left), "n_spans": spans, "kept": left}
        )
    return pa.array(out, _ARROW_RESULT)


def remove_repeats(documents: DataFrame, least: int = LEAST) -> DataFrame:
    """All columns plus ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept``, the remaining bytes, one row per input row.

    Earlier is the smaller ``doc_id``, then the earlier start; a null id is before all others,
    and of different texts with one id either may count as the earlier, always the same one.
    Repeated rows (id and text equal) are one document to each other and get the same result.
    Null texts are empty. Columns named like the new ones are replaced. ``least`` is a multiple
    of five between 40 and 100.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "repeats")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = documents.select(
        F.col("doc_id").cast("long"),
        F.xxhash64(text).alias("print"),
        text.cast("binary").alias("text"),
    )
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / BYTES_PER_SHARD))
    found = scratch.store(_found(keyed, shards, least), "found")
    scratch.release()
    shared = found.filter(F.col("anchor").isNotNull())
    ranges = found.filter(F.col("anchor").isNull()).drop("anchor")
    compared = scratch.store(_compared(scratch, keyed, shared, least), "compared")
    scratch.drop("pieces")
    scratch.release()
    ranges = ranges.union(compared).groupBy("doc_id", "print")
    hidden = unused(documents.columns, "_id", "_print", "_gone", "_result")
    id_name, print_name, gone_name, result_name = hidden
    ranges = ranges.agg(F.collect_list(F.struct("start", "stop")).alias(gone_name))
    ranges = ranges.withColumnsRenamed({"doc_id": id_name, "print": print_name})
    new = ("n_bytes", "n_removed", "n_spans", "kept")
    columns = [c for c in documents.columns if c not in new]
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    marked = documents.withColumn(id_name, own).withColumn(print_name, F.xxhash64(text))
    joined = marked.join(ranges, [id_name, print_name], "left")
    result = F.arrow_udf(_removed, _RESULT)(text.cast("binary"), F.col(gone_name))
    done = joined.withColumn(result_name, result)
    return done.select(*columns, *(F.col(f"{result_name}.{c}") for c in new))
