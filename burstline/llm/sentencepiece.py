"""Sampled segmentations over the lattice of a piece vocabulary, and lossless decoding.

All ways to write a text as pieces form a lattice. Forward filtering adds up the weight of all
paths to each position; backward sampling then draws pieces from the end, each with its share of
the paths that end there. So a segmentation comes up with exactly its share of the total weight.

The weight of a piece is 1 / (1 + rank) ** alpha, its rank in the order of merges: the smaller
alpha, the more even the draw. Random numbers are hashes of the row's key and the position, so a
row has the same segmentation in any partitioning and after any retry.

No piece has a space after another character, nor a line break inside, so the lattice falls apart
into units there. The filtered weights of a unit are kept in the worker and drawn from for each
place where it occurs; a batch of texts is drawn at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.storage import values

ALPHA = 0.5
SEED = 1
SPACE = "▁"  # how the vocabulary writes a space
_UNIT = r" +[^ \n]*|[^ \n]+|\n"
# Words of these letters are units of their own before these marks, if no piece spans the two.
_LETTER, _MARK = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]", "[.,;:!?|]"
_WORD = rf" *{_LETTER}+(?=[ \n]|{_MARK}|\Z)"
_LONG = 64  # units of more characters are filtered on their own
_LEARNT_CHARS = 1 << 16
_BATCH_CHARS = 1 << 20
_MOST_KEPT = 300_000
_MOST_KEPT_CANDIDATES = 6_000_000
_TINY, _SCALE, _LEAST = 1e-150, 1e150, 1e-250
_BASE = np.uint64(0x9E3779B97F4A7C15)
_FILTER_BITS = 18
_ONE = 1 << 24  # shares are whole numbers of it, so that draws do not depend on rounding


class Vocabulary:
    """The pieces of a SentencePiece model, spaces as spaces."""

    def __init__(self, model_path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        size = model.get_piece_size()
        self.ids: dict[str, int] = {}
        self.written: list[bytes] = [b""] * size
        self.byte_ids = [0] * 256
        self.ranks = np.full(size, float(size))
        for k in range(size):
            piece = model.id_to_piece(k)
            if model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                continue
            if model.is_byte(k):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = k
                self.written[k] = bytes([value])
                continue
            text = piece.replace(SPACE, " ")
            self.ids[text] = k
            self.written[k] = text.encode()
            # User-defined pieces have no rank and count as the last.
            score = model.get_score(k)
            self.ranks[k] = -score if -size < score <= 0 else size
        self.longest = max(map(len, self.ids))
        spans = re.compile(_LETTER + _MARK)
        words = not any(map(spans.search, self.ids))
        self.unit = re.compile(f"{_WORD}|{_UNIT}" if words else _UNIT)
        self._index()

    def _index(self) -> None:
        """Hashes of the pieces by length, and a filter that turns most other strings away."""
        self.hashes, self.hashed_ids, self.filters = [], [], []
        for n in range(1, self.longest + 1):
            own = [x for x in self.ids if len(x) == n]
            codes = np.frombuffer("".join(own).encode("utf-32-le"), np.uint32).reshape(-1, n)
            hashes = np.zeros(len(own), np.uint64)
            for k in range(n):
                hashes += _char_hash(codes[:, n - 1 - k], k)
            order = np.argsort(hashes)
            known = np.zeros(1 << _FILTER_BITS, bool)
            known[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.hashes.append(hashes[order])
            self.hashed_ids.append(np.array([self.ids[x] for x in own], np.int64)[order])
            self.filters.append(known)

    def pieces_at(self, codes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """The pieces that end at each character: character, width and id, in that order.
        ``place`` is the character's place in its unit, from 1."""
        running = np.zeros(len(codes), np.uint64)
        rows, widths, ids = [], [], []
        inside = np.arange(len(codes))
        for k in range(self.longest):
            inside = inside[place[inside] > k]
            if not len(inside):
                break
            own = running[inside] + _char_hash(codes[inside - k], k)
            running[inside] = own
            likely = np.flatnonzero(self.filters[k][own >> np.uint64(64 - _FILTER_BITS)])
            if len(likely):
                own = own[likely]
                at = np.minimum(np.searchsorted(self.hashes[k], own), len(self.hashes[k]) - 1)
                same = self.hashes[k][at] == own
                rows.append(inside[likely[same]])
                widths.append(np.full(len(rows[-1]), k + 1))
                ids.append(self.hashed_ids[k][at[same]])
        if not rows:
            return (np.zeros(0, np.int64),) * 3
        rows, widths, ids = (np.concatenate(x) for x in (rows, widths, ids))
        order = np.argsort(rows * 64 + widths)
        return rows[order], widths[order], ids[order]


def _char_hash(codes: np.ndarray, from_end: int) -> np.ndarray:
    """The part of a string's hash that a character at this distance from its end makes."""
    turn = np.uint64(pow(int(_BASE) | 1, from_end + 1, 2**64))
    return _mixed(codes.astype(np.uint64) + np.uint64(1)) * turn


class Lattice:
    """Filtered weights of units, in flat arrays."""

    def __init__(self, vocabulary: Vocabulary, alpha: float = ALPHA):
        self.vocabulary = vocabulary
        self.weights = (1 + vocabulary.ranks) ** -alpha
        self.weight = self.weights.tolist()
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.base = np.zeros(0, np.int64)  # first row of a unit; one row for each end position
        self.length = np.zeros(0, np.int64)
        self.edges = np.zeros(0, np.int64)  # row and cumulated share, ascending over all rows
        self.width = np.zeros(0, np.int8)  # characters of a candidate piece
        self.piece = np.zeros(0, np.int32)  # its id, or -1 - code point for byte fallback
        self.rows = 0
        self.uses = np.zeros(0, np.int64)

    def filtered(self, unit: str) -> Iterator[list[tuple[int, int, int]]]:
        """For each end position the pieces that end there: cumulated share of the paths in
        2^-24, width and id. Weights of positions are scaled as they get small."""
        ids, weight, longest = self.vocabulary.ids, self.weight, self.vocabulary.longest
        paths = [1.0]
        for end in range(1, len(unit) + 1):
            total, found = 0.0, []
            for start in range(end - 1, max(-1, end - 1 - longest), -1):
                piece = ids.get(unit[start:end])
                if piece is not None:
                    found.append((paths[start] * weight[piece], end - start, piece))
                    total += found[-1][0]
                elif start == end - 1:
                    width = len(unit[start].encode())
                    own = paths[start] * weight[self.vocabulary.byte_ids[0]] ** width
                    found.append((own, 1, -1 - ord(unit[start])))
                    total += own
            paths.append(total)
            if total < _TINY:
                for k in range(max(0, end + 1 - longest), end + 1):
                    paths[k] *= _SCALE
            rising = [int(weight / total * _ONE) for weight, _, _ in found]
            rising = np.cumsum(rising).tolist()
            rising[-1] = _ONE
            yield [(share, width, piece) for share, (_, width, piece) in zip(rising, found)]

    def _filtered_alike(self, units: list[str]) -> tuple[np.ndarray, ...]:
        """The same for many short units at once, position by position: how many pieces end at
        each position, their cumulated shares, widths and ids, and which units are too unlikely
        for that."""
        longest = self.vocabulary.longest
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        first = np.cumsum(lengths) - lengths
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        place = np.arange(len(codes)) - np.repeat(first, lengths) + 1
        rows, widths, ids = self.vocabulary.pieces_at(codes, place)
        weights = self.weights[ids]
        single = np.ones(len(codes), bool)
        single[rows[widths == 1]] = False
        alone = np.flatnonzero(single)
        if len(alone):
            size = 1 + (codes[alone] > 0x7F) + (codes[alone] > 0x7FF) + (codes[alone] > 0xFFFF)
            rows = np.concatenate([rows, alone])
            widths = np.concatenate([widths, np.ones(len(alone), np.int64)])
            ids = np.concatenate([ids, -1 - codes[alone].astype(np.int64)])
            by_bytes = self.weights[self.vocabulary.byte_ids[0]] ** size
            weights = np.concatenate([weights, by_bytes])
            order = np.argsort(rows * 64 + widths)
            rows, widths, ids, weights = (x[order] for x in (rows, widths, ids, weights))
        counts = np.bincount(rows, minlength=len(codes))
        origin = first + np.arange(len(units))  # of each unit's paths, one more than its rows
        target = np.arange(len(codes)) + np.repeat(np.arange(len(units)), lengths) + 1
        paths = np.zeros(len(codes) + len(units))
        paths[origin] = 1.0
        source = target[rows] - widths
        # Edges and rows by the place at which they end, in the order of rows.
        edge_order = np.argsort(place[rows], kind="stable")
        row_order = np.argsort(place, kind="stable")
        places = np.arange(1, int(lengths.max()) + 2)
        edge_cuts = np.searchsorted(place[rows][edge_order], places)
        row_cuts = np.searchsorted(place[row_order], places)
        parts = np.zeros(len(rows))
        for k in range(len(places) - 1):
            edges = edge_order[edge_cuts[k] : edge_cuts[k + 1]]
            ends = row_order[row_cuts[k] : row_cuts[k + 1]]
            part = paths[source[edges]] * weights[edges]
            parts[edges] = part
            own = counts[ends]
            paths[target[ends]] = np.add.reduceat(part, np.cumsum(own) - own)
        total = paths[target]
        unlikely = np.minimum.reduceat(total, first) < _LEAST
        shares = (parts / np.maximum(total, _LEAST)[rows] * _ONE).astype(np.int64)
        rising = np.cumsum(shares)
        last = np.cumsum(counts) - 1
        rising -= np.repeat(rising[last] - np.add.reduceat(shares, last + 1 - counts), counts)
        rising[last] = _ONE
        return counts, rising, widths, ids, unlikely

    def _learn(self, units: list[str]) -> None:
        short = [u for u in units if len(u) <= _LONG]
        first, chars = 0, 0
        for k, unit in enumerate(short):
            chars += len(unit)
            if chars > _LEARNT_CHARS or k == len(short) - 1:
                self._learn_alike(short[first : k + 1])
                first, chars = k + 1, 0
        for unit in units:
            if len(unit) > _LONG:
                self._learn_one(unit)

    def _learn_alike(self, units: list[str]) -> None:
        counts, shares, widths, ids, unlikely = self._filtered_alike(units)
        if unlikely.any():
            for k in np.flatnonzero(unlikely).tolist():
                self._learn_one(units[k])
            likely = [u for u, x in zip(units, unlikely) if not x]
            if likely:
                self._learn_alike(likely)
            return
        self._keep(units, counts, shares, widths, ids)

    def _learn_one(self, unit: str) -> None:
        found = list(self.filtered(unit))
        flat = [x for row in found for x in row]
        shares, widths, ids = (np.array(x) for x in zip(*flat))
        self._keep([unit], np.array([len(x) for x in found]), shares, widths, ids)

    def _keep(self, units: list[str], counts, shares, widths, ids) -> None:
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        row = self.rows + np.repeat(np.arange(len(counts)), counts)
        edges = row * _ONE + shares
        self.slot.update(zip(units, range(len(self.slot), len(self.slot) + len(units))))
        self.base = np.concatenate([self.base, self.rows + np.cumsum(lengths) - lengths])
        self.rows += len(counts)
        self.length = np.concatenate([self.length, lengths])
        self.edges = np.concatenate([self.edges, edges])
        self.width = np.concatenate([self.width, widths.astype(np.int8)])
        self.piece = np.concatenate([self.piece, ids.astype(np.int32)])

    def _slots(self, units: list[str]) -> np.ndarray:
        if len(self.slot) > _MOST_KEPT or len(self.edges) > _MOST_KEPT_CANDIDATES:
            self._thin_out()
        slots = np.fromiter(map(self.slot.get, units, repeat(-1)), np.int64, len(units))
        missed = np.flatnonzero(slots < 0).tolist()
        if missed:
            self._learn(list(dict.fromkeys(units[k] for k in missed)))
            slots[missed] = [self.slot[units[k]] for k in missed]
        n = len(self.slot)
        uses = np.bincount(slots, minlength=n)
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        return slots

    def _thin_out(self) -> None:
        """Forgets the units that were used once, and if need be the rarer half."""
        least = max(2, int(np.median(self.uses)) + 1)
        stay = np.flatnonzero(self.uses >= least)
        names = list(self.slot)
        kept = [names[k] for k in stay.tolist()]
        row_of = (self.edges - 1) // _ONE
        staying = np.zeros(self.rows, bool)
        lengths = self.length[stay]
        rows = np.repeat(self.base[stay] - (np.cumsum(lengths) - lengths), lengths)
        rows = rows + np.arange(len(rows))
        staying[rows] = True
        own = staying[row_of]
        counts = np.bincount(row_of, minlength=self.rows)[rows]
        shares = self.edges[own] - row_of[own] * _ONE
        widths, ids = self.width[own], self.piece[own]
        self._clear()
        if kept:
            self._keep(kept, counts, shares, widths, ids)

    def sample(self, units: list[str], seeds: np.ndarray, starts: np.ndarray):
        """Ids of all units one after the other, and how many each unit has. ``seeds`` and
        ``starts`` (the unit's place in its text) make the random numbers."""
        slots = self._slots(units)
        base, left = self.base[slots], self.length[slots].copy()
        count = np.zeros(len(units), np.int64)
        steps = []
        active = np.argsort(slots, kind="stable")  # units alike side by side, which the cache likes
        active = active[left[active] > 0]
        while len(active):
            end = left[active]
            drawn = _uniform(seeds[active], starts[active] + end)
            row = base[active] + end - 1
            at = np.searchsorted(self.edges, row * _ONE + drawn, side="right")
            steps.append((active, self.piece[at]))
            left[active] = end - self.width[at]
            count[active] += 1
            active = active[left[active] > 0]
        out = np.zeros(int(count.sum()), np.int64)
        last = np.cumsum(count) - 1
        for step, (which, pieces) in enumerate(steps):
            out[last[which] - step] = pieces
        return self._with_bytes(out, count)

    def _with_bytes(self, ids: np.ndarray, count: np.ndarray):
        """Characters without a piece become the pieces of their bytes."""
        missing = np.flatnonzero(ids < 0)
        if not len(missing):
            return ids, count
        written = {
            c: [self.vocabulary.byte_ids[b] for b in chr(-1 - c).encode()]
            for c in np.unique(ids[missing]).tolist()
        }
        parts = [written[c] for c in ids[missing].tolist()]
        extra = np.fromiter(map(len, parts), np.int64, len(parts)) - 1
        owner = np.repeat(np.arange(len(count)), count)[missing]
        copies = np.ones(len(ids), np.int64)
        copies[missing] += extra
        wide = np.repeat(ids, copies)
        wide[wide < 0] = [b for part in parts for b in part]
        return wide, count + np.bincount(owner, extra, len(count)).astype(np.int64)

    def encode(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """A sampled segmentation of each text; texts of one key and content get the same."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        units: list[str] = []
        owners: list[tuple[int, int]] = []
        chars = 0
        for k, text in enumerate(texts):
            if text:
                found = self.vocabulary.unit.findall(" " + text)  # the space that a model puts in front
                units += found
                owners.append((k, len(found)))
                chars += len(text)
            if chars > _BATCH_CHARS or k == len(texts) - 1:
                self._flush(units, owners, keys, out)
                units, owners, chars = [], [], 0
        return out

    def _flush(self, units, owners, keys, out) -> None:
        if not units:
            return
        per_text = np.array([n for _, n in owners])
        seeds = np.array([keys[k] & (2**64 - 1) for k, _ in owners], np.uint64)
        seeds = _mixed(seeds + np.uint64(SEED))
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(lengths)
        first_unit = np.cumsum(per_text) - per_text
        origin = np.repeat((ends - lengths)[first_unit], per_text)
        ids, count = self.sample(units, np.repeat(seeds, per_text), ends - lengths - origin)
        sums = np.add.reduceat(count, first_unit)
        parts = np.split(ids.astype(np.int32), np.cumsum(sums)[:-1])
        for (k, _), part in zip(owners, parts):
            out[k] = part

    def decode(self, ids: list[int]) -> str:
        """The text that the ids were made from."""
        text = b"".join(map(self.vocabulary.written.__getitem__, ids))
        return text[1:].decode("utf-8", "replace")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers from 0 to 2^24 - 1."""
    x = _mixed(seeds + places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (x >> np.uint64(40)).astype(np.int64)


_LATTICES: dict[tuple[str, float], Lattice] = {}


def lattice(model_path: str, alpha: float = ALPHA) -> Lattice:
    """One per Python worker, kept across its tasks."""
    if (model_path, alpha) not in _LATTICES:
        _LATTICES[model_path, alpha] = Lattice(Vocabulary(model_path), alpha)
    return _LATTICES[model_path, alpha]


def encoded(text: Column, key: Column, model_path: str, alpha: float = ALPHA) -> Column:
    """Sampled ids of texts, seeded by a key per row. Null stays null, an empty text has no ids,
    a null key counts as 0."""

    def encode(texts: pa.Array, keys: pa.Array) -> pa.Array:
        own = lattice(model_path, alpha)
        chunks = []
        for first in range(0, len(texts), 256):
            some = texts.slice(first, 256).to_pylist()
            seeds = [k or 0 for k in keys.slice(first, 256).to_pylist()]
            found = own.encode([t or "" for t in some], seeds)
            rows = [None if t is None else x for t, x in zip(some, found)]
            chunks.append(pa.array(rows, pa.list_(pa.int32())))
        return pa.concat_arrays(chunks) if chunks else pa.array([], pa.list_(pa.int32()))

    return F.arrow_udf(encode, "array<int>")(text.cast("string"), key.cast("long"))


def segmented(texts: DataFrame, key: str, model_path: str, alpha: float = ALPHA) -> DataFrame:
    """The key column, ``ids`` and ``lossless``: whether decoding the ids gives the text back.

    A null text has null ids and counts as lossless, an empty text has none; rows with equal
    key and text have equal ids. Other columns are not read.
    """
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(model_path, alpha)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                given = some.column("text").to_pylist()
                seeds = [k or 0 for k in some.column("seed").to_pylist()]
                found = own.encode([t or "" for t in given], seeds)
                back = [own.decode(x.tolist()) == (t or "") for t, x in zip(given, found)]
                rows = [None if t is None else x for t, x in zip(given, found)]
                columns = [some.column("key"), pa.array(rows, pa.list_(pa.int32())), pa.array(back)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "lossless"])

    chosen = texts.select(
        F.col(key).alias("key"), F.col(key).cast("long").alias("seed"), F.col("text").cast("string")
    )
    out = chosen.mapInArrow(run, f"key {kind}, ids array<int>, lossless boolean")
    return out.withColumnRenamed("key", key)


def decoded(ids: Column, model_path: str) -> Column:
    """Texts of ids; null stays null."""

    def decode(rows: pa.Array) -> pa.Array:
        own = lattice(model_path)
        return pa.array([None if x is None else own.decode(x) for x in values(rows)], pa.string())

    return F.arrow_udf(decode, "string")(ids)
