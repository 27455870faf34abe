"""Ids of a byte-level tokenizer for columns of texts, without a loop over words.

A batch of texts is cut into units on its bytes: a word with the space before it, a run of digits
or of punctuation, white space. The tokenizer's own split has a boundary at each cut, so the ids of
a text are those of its units one after the other. Units are looked up all at once in a table that
holds, by a hash of the unit, its bytes and its ids; what is not there is encoded by the library
and put in, in place of what stood there. Bytes are compared, so a hash decides nothing but the
place. Long units, texts with special tokens and texts with white space beyond ASCII go to the
library as they are.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GLUED, LETTER, DIGIT, MARK, SPACE, BREAK = range(6)
_CHUNK = 1 << 20  # bytes of text taken at a time
_SLOTS = 1 << 20
_WORDS = 3  # a unit in the table has at most three words of eight bytes
_MOST_IDS = 8  # and at most so many ids
_AT_ONCE = 2048
_CUT = re.compile(rb"(?<=[^ \t-\r])[ \t-\r]")
# Characters on which this cut and the tokenizer may disagree whether they are white space.
_DOUBTFUL = "[\x1c-\x1f\x85  ᠎ -​    ⁠　﻿]"
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _classes() -> np.ndarray:
    """The class of a byte. An apostrophe and bytes beyond ASCII hold on to their neighbours."""
    found = np.full(256, GLUED, np.uint8)
    for byte in range(33, 127):
        letter = chr(byte)
        found[byte] = LETTER if letter.isalpha() else DIGIT if letter.isdigit() else MARK
    found[ord("'")] = GLUED
    found[9:14] = BREAK
    found[32] = SPACE
    return found


def _boundaries() -> np.ndarray:
    """Whether a unit starts between a byte of one class and one of the other."""
    found = np.zeros((6, 6), bool)
    for a in (LETTER, DIGIT, MARK):
        for b in (LETTER, DIGIT, MARK):
            found[a, b] = a != b
    found[: MARK + 1, SPACE:] = True
    found[BREAK, : MARK + 1] = True
    return found.reshape(-1)


# Texts that tokenizers of other kinds take otherwise.
_PROBES = [" It's 12,345.60  of\n\n the l'\u00c9t\u00e9\t(x2) \u4e2d\u6587, e\u0301!\r\n", "'ll  ", "A b"]

_CLASS, _BOUNDARY = _classes(), _boundaries()
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def unit_starts(data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units start, and the classes of all bytes. ``firsts`` are the places where texts
    start, the end included."""
    kind = _CLASS[data]
    if not len(data):
        return np.zeros(0, np.int64), kind
    two = np.flatnonzero(data[:-1] == 0xC3)
    if len(two):  # Latin letters of two bytes
        second = data[two + 1]
        two = two[(second != 0x97) & (second != 0xB7)]
        kind[two] = kind[two + 1] = LETTER
    starts = np.zeros(len(data), bool)
    starts[1:] = _BOUNDARY[kind[:-1] * np.uint8(6) + kind[1:]]
    blank = kind >= SPACE
    last_blank = blank.copy()
    last_blank[:-1] &= ~blank[1:]
    ends = firsts[1:][firsts[1:] > 0] - 1
    last_blank[ends] = False  # white space that ends a text is one unit
    starts |= last_blank
    starts[firsts[firsts < len(data)]] = True
    return np.flatnonzero(starts), kind


class UnitIds:
    """Ids of texts, as the library gives them without the tokens that it adds.

    For byte-level BPE that splits at white space, digits and punctuation as GPT-2's does, and for
    the kind that marks word ends, lower-cases and drops white space; others are refused.
    """

    def __init__(self, tokenizer_path: str, slots: int = _SLOTS):
        # A task has one core; threads of the library would only wait for each other.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(re.escape(x) for x in special)
        self.model = self.tokenizer.model
        # With word ends marked, the space before a word is no part of it.
        self.lower = bool(self.model.end_of_word_suffix)
        # The bytes of letters and spaces that are not written as themselves.
        self.letters = [(chr(b), c) for b, c in _byte_letters().items() if b >= 128 or b == 32]
        self.slots = slots
        self.key = np.zeros((_WORDS, slots), np.uint64)
        self.count = np.zeros(slots, np.uint8)
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.ids = np.zeros(slots * _MOST_IDS, np.uint16 if small else np.uint32)
        found = [x.tolist() for x in self.encode(pa.array(_PROBES))]
        if found != [x.tolist() for x in self._library(_PROBES)]:
            raise ValueError(f"{tokenizer_path} cuts texts where this module does not")

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null texts have none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        out: list[np.ndarray | None] = [None] * len(texts)
        odd = pc.match_substring_regex(texts, _DOUBTFUL)
        if self.special:
            odd = pc.or_(odd, pc.match_substring_regex(texts, self.special))
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        for k in whole:
            out[k] = self._library([texts[k].as_py()])[0]
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[
            texts.offset : texts.offset + len(texts) + 1
        ]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        for first, last, firsts in self._pieces(data, offsets):
            ids, counts = self._ids(data, firsts)
            ends = np.concatenate([[0], np.cumsum(counts)])
            if last - first == 1:  # one text, maybe in several pieces
                part = ids
                if out[first] is None:
                    out[first] = part
                elif first not in whole:
                    out[first] = np.concatenate([out[first], part])
                continue
            for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist()), first):
                if out[k] is None:
                    out[k] = ids[a:b]
        return [np.zeros(0, np.uint32) if x is None else x for x in out]

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        """Runs of texts of some size; a longer text is cut before white space."""
        first, n = 0, len(offsets) - 1
        while first < n:
            last = int(np.searchsorted(offsets, offsets[first] + _CHUNK, "right")) - 1
            last = min(max(last, first), n)
            if last > first:
                yield first, last, offsets[first : last + 1]
                first = last
                continue
            at, end = int(offsets[first]), int(offsets[first + 1])
            view = memoryview(data)
            while end - at > _CHUNK:
                found = _CUT.search(view, at + _CHUNK, end)
                if found is None:
                    break
                yield first, first + 1, np.array([at, found.start()])
                at = found.start()
            yield first, first + 1, np.array([at, end])
            first += 1

    def _ids(self, data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of neighbouring texts, and how many each text has."""
        low, high = int(firsts[0]), int(firsts[-1])
        part = np.zeros(high - low + 8 * _WORDS, np.uint8)
        part[: high - low] = data[low:high]
        places = firsts - low
        starts, kind = unit_starts(part[: high - low], places)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(firsts) - 1, np.int64)
        lengths = np.diff(starts, append=high - low)
        words = np.ndarray((high - low + 8 * (_WORDS - 1) + 1,), "<u8", part, strides=(1,))
        key = np.empty((_WORDS, len(starts)), np.uint64)
        mixed = lengths.astype(np.uint64)
        for k in range(_WORDS):
            key[k] = words[starts + 8 * k] & _MASK[np.clip(lengths - 8 * k, 0, 8)]
            mixed = (mixed ^ key[k]) * _ODD[k]
            mixed ^= mixed >> np.uint64(29)
        slot = (mixed * _ODD[0] >> np.uint64(32)).astype(np.int64) & (self.slots - 1)
        known = (self.key[0][slot] == key[0]) & (self.count[slot] > 0)
        for k in range(1, _WORDS):
            known &= self.key[k][slot] == key[k]
        known &= lengths <= 8 * _WORDS
        counts = self.count[slot].astype(np.int64)
        source = slot * _MOST_IDS
        extra = np.zeros(0, np.uint32)
        missed = np.flatnonzero(~known)
        if len(missed):
            extra = self._learn(part, kind, starts, lengths, key, mixed, missed, counts, source)
        ends = np.cumsum(counts)
        where = np.repeat(source - (ends - counts), counts)
        where += np.arange(len(where))
        if len(extra):
            own = np.repeat(source >= len(self.ids), counts)
            ids = np.empty(len(where), np.uint32)
            ids[~own] = self.ids[where[~own]]
            ids[own] = extra[where[own] - len(self.ids)]
        else:
            ids = self.ids[where].astype(np.uint32, copy=False)
        if len(missed):
            self._keep(key, slot, lengths, missed, counts, source, extra)
        per_unit = np.concatenate([[0], ends])
        at = np.searchsorted(starts, places)
        return ids, np.diff(per_unit[at])

    def _learn(self, part, kind, starts, lengths, key, mixed, missed, counts, source):
        """Encodes what the table does not hold, each unit once. Sets counts and places, beyond
        the table's own, in the ids that it gives back."""
        raw = part.tobytes()
        at, size = starts[missed], lengths[missed]
        _, one, same = np.unique(mixed[missed], return_index=True, return_inverse=True)
        # Long units, and the rare ones that share the hash of others, are told apart by bytes.
        apart = size > 8 * _WORDS
        for k in range(_WORDS):
            apart |= key[k][missed] != key[k][missed[one[same]]]
        apart |= size != size[one[same]]
        units = [raw[a : a + n] for a, n in zip(at[one].tolist(), size[one].tolist())]
        # One word for the tokenizer: letters whose class no Unicode version changes.
        others = np.concatenate([[0], np.cumsum(kind != LETTER, dtype=np.int32)])
        others = others[at[one] + size[one]] - others[at[one]]
        plain = (others == 0) | ((others == 1) & (part[at[one]] == 32) & (size[one] > 1))
        unit_of = same.copy()
        if apart.any():
            named: dict[bytes, int] = {}
            for k in np.flatnonzero(apart).tolist():
                unit = raw[at[k] : at[k] + size[k]]
                unit_of[k] = named.setdefault(unit, len(units) + len(named))
            units += named
            plain = np.concatenate([plain, np.zeros(len(named), bool)])
        ids, n = self._encode(units, plain)
        ends = np.cumsum(n)
        counts[missed] = n[unit_of]
        source[missed] = len(self.ids) + (ends - n)[unit_of]
        return ids

    def _keep(self, key, slot, lengths, missed, counts, source, extra) -> None:
        fit = (lengths[missed] <= 8 * _WORDS) & (counts[missed] <= _MOST_IDS) & (counts[missed] > 0)
        some = missed[fit]
        # Of units that want one place the last gets it, with all its parts.
        owner = np.full(self.slots, -1, np.int64) if len(some) > self.slots // 8 else None
        if owner is not None:
            owner[slot[some]] = some
            some = owner[owner >= 0]
        else:
            _, last = np.unique(slot[some][::-1], return_index=True)
            some = some[len(some) - 1 - last]
        at = slot[some]
        for k in range(_WORDS):
            self.key[k][at] = key[k][some]
        self.count[at] = counts[some]
        first = source[some] - len(self.ids)
        for k in range(_MOST_IDS):
            more = counts[some] > k
            self.ids[at[more] * _MOST_IDS + k] = extra[first[more] + k]

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in encoded]

    def _encode(self, units: list[bytes], is_plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units one after the other, and how many each has."""
        plain = np.flatnonzero(is_plain).tolist()
        other = np.flatnonzero(~is_plain).tolist()
        counts = np.zeros(len(units), np.int64)
        parts: list[np.ndarray] = []
        order: list[int] = []
        for first in range(0, len(plain), _AT_ONCE):
            some = plain[first : first + _AT_ONCE]
            ids, n = self._plain([units[k] for k in some])
            counts[some] = n
            parts.append(ids)
            order += some
        for first in range(0, len(other), _AT_ONCE):
            some = other[first : first + _AT_ONCE]
            found = self._library([units[k].decode("utf-8", "replace") for k in some])
            counts[some] = [len(x) for x in found]
            parts += found
            order += some
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        # Back from the order of encoding to that of the units.
        n = counts[order]
        ends = np.cumsum(n)
        begin = np.empty(len(units), np.int64)
        begin[order] = ends - n
        ends = np.cumsum(counts)
        where = np.repeat(begin - (ends - counts), counts)
        where += np.arange(len(where))
        return flat[where].astype(np.uint32), counts

    def _plain(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Single words go straight to the tokenizer's model, as it would be given them."""
        text = b"\n".join(units)
        if self.lower:  # the normalizer drops white space and lower-cases
            text = text.replace(b" ", b"").decode().lower().encode()
        text = text.decode("latin-1")
        for written, letter in self.letters:
            text = text.replace(written, letter)
        words = text.split("\n")
        tokenize = self.model.tokenize
        found = [[token.id for token in tokenize(word)] for word in words]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(counts.sum()))
        return ids, counts


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as itself where that is a visible Latin-1 character,
    the others, in order, as the characters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_KNOWN: dict[tuple[str, int], UnitIds] = {}


def unit_ids(tokenizer_path: str, slots: int = _SLOTS) -> UnitIds:
    """One per Python worker, kept across its tasks. A slot takes 41 bytes."""
    if (tokenizer_path, slots) not in _KNOWN:
        _KNOWN[tokenizer_path, slots] = UnitIds(tokenizer_path, slots)
    return _KNOWN[tokenizer_path, slots]
