"""An adaptive context-mixing range coder for ids, many blocks in step.

The probability of an id is a mixture of three predictions. Order 2 and order 1 each predict the id
that last followed the same two ids, or the same one, in the block. Order 0 predicts a class of ids
of like frequency by the classes seen so far, and each id of a class alike. The weights of the
mixture are chosen by whether the two predictions have held before and whether they agree, and
move with every id towards the order that was right. An id that two orders predict is coded by the
higher one. The mixture gives each id an interval, and a range coder narrows its range to it.

Everything is whole numbers, so a decoder on another machine makes the same steps. All state
starts anew with each block, and a block is decoded from its own bytes and the ranks of its chunk
alone. Blocks do not depend on each other, so numpy codes one id of each block at a time.

Ids are given as ranks by frequency, from 1. A class holds the ranks of one bit length.
"""

from __future__ import annotations

import numpy as np

CLASSES = 16
MOST_RANKS = (1 << CLASSES) - 1
_ONE = 1 << 15  # probabilities are shares of this
_SURE = 1000  # what a weight gains: two weights together never get beyond 32 times this
_LEAST = 64  # a class never gets less
_SPAN = np.int16(_ONE - _LEAST * CLASSES)
_RATE = 5
_SLOTS_1, _SLOTS_2 = 1024, 2048
_STATES = 32
_15, _32 = np.uint64(15), np.uint64(32)
_LOW_32 = np.uint64(0xFFFFFFFF)


def class_of(ranks: np.ndarray) -> np.ndarray:
    """The class of each rank: its bit length less one, from the exponent of a float."""
    return (ranks.astype(np.float32).view(np.int32) >> 23) - 127


class _Model:
    """What each of so many blocks has learned. An entry of an order is four times a rank, and
    1 for a rank seen once in its place or 3 for one that has held."""

    def __init__(self, lanes: int):
        lane = np.arange(lanes, dtype=np.int32)
        self.lane = lane
        self.lanes = np.int32(lanes)
        self.seen_1 = np.zeros(lanes * _SLOTS_1, np.int32)
        self.seen_2 = np.zeros(lanes * _SLOTS_2, np.int32)
        self.base_1, self.base_2 = lane * _SLOTS_1, lane * _SLOTS_2
        # Weights of order 2 and order 1, packed; order 0 has the rest.
        self.weights = np.full(lanes * _STATES, (_ONE // 8 << 16) + _ONE // 8, np.int32)
        self.base_w = lane * _STATES
        # The bounds of the classes, the two outer ones included.
        steps = np.arange(CLASSES + 1) * (_ONE // CLASSES)
        self.bounds = np.repeat(steps.astype(np.uint16)[:, None], lanes, 1)
        self.inner = self.bounds[1:-1]
        self.signed = self.inner.view(np.int16)
        self.flat = self.bounds.reshape(-1)
        self.number = np.arange(1, CLASSES, dtype=np.int16)[:, None]
        self.low = (self.number * _LEAST).astype(np.int16)
        self.high = self.low + _SPAN
        self.step = np.empty((CLASSES - 1, lanes), np.int16)
        self.above = np.empty((CLASSES - 1, lanes), bool)
        self.at_1 = self.base_1.astype(np.int64)
        self.at_2 = self.base_2.astype(np.int64)
        self.before = np.zeros(lanes, np.int32)

    def predict(self) -> None:
        """Sets what the two orders predict and their weights."""
        self.entry_1 = entry_1 = self.seen_1.take(self.at_1)
        self.entry_2 = entry_2 = self.seen_2.take(self.at_2)
        self.guess_1 = entry_1 >> 2
        self.guess_2 = entry_2 >> 2
        state = (entry_2 & 3) << 2
        state |= entry_1 & 3
        state <<= 1
        state |= self.guess_1 == self.guess_2
        state += self.base_w
        self.at_w = state.astype(np.int64)
        self.packed = self.weights.take(self.at_w)
        self.w_2 = self.packed >> 16
        self.w_1 = self.packed & 0xFFFF

    def interval(self, kind: np.ndarray, left: np.ndarray, both: np.ndarray):
        """Where the share of a class starts and stops."""
        place = kind * self.lanes
        place += self.lane
        start = left * self.flat.take(place)
        place += self.lanes
        stop = left * self.flat.take(place)
        start >>= 15
        stop >>= 15
        start += both
        stop += both
        return start, stop

    def learn(self, rank: np.ndarray, right_1, right_2, kind: np.ndarray) -> None:
        """Takes the ids that came, whether each order was right, and their classes."""
        # What a weight loses is rounded down, so none gets to zero.
        w_2 = self.w_2 - (self.w_2 >> _RATE)
        w_1 = self.w_1 - (self.w_1 >> _RATE)
        w_2 <<= 16
        w_2 += w_1
        w_2 += np.where(right_2, np.int32(_SURE << 16), np.int32(_SURE) * right_1)
        self.weights[self.at_w] = w_2
        new = rank << 2
        new |= 1
        self.seen_1[self.at_1] = np.where(right_1, self.entry_1 | 2, new)
        self.seen_2[self.at_2] = np.where(right_2, self.entry_2 | 2, new)
        np.greater(self.number, kind.astype(np.int16), out=self.above)
        np.subtract(self.low, self.signed, out=self.step)
        self.step += self.above * _SPAN
        self.step >>= _RATE
        self.signed += self.step
        at = rank & (_SLOTS_1 - 1)
        at += self.base_1
        self.at_1 = at.astype(np.int64)
        mixed = rank * np.int32(30011)
        at = (self.before + mixed) >> 4
        at &= _SLOTS_2 - 1
        at += self.base_2
        self.at_2 = at.astype(np.int64)
        mixed *= np.int32(13)
        self.before = mixed


def encode(ranks: np.ndarray) -> list[bytes]:
    """Codes blocks of one length, one per row."""
    lanes, length = ranks.shape
    if lanes == 0:
        return []
    if ranks.min() < 1 or ranks.max() > MOST_RANKS:
        raise ValueError("ranks go from 1 to 65535")
    by_step = np.ascontiguousarray(ranks.T)
    model = _Model(lanes)
    low = np.zeros(lanes, np.uint64)
    span = np.full(lanes, 2**64 - 1, np.uint64)
    room = length + 4
    out = np.zeros(lanes * room, np.uint32)
    end = np.arange(lanes, dtype=np.int64) * room
    begin = end.copy()
    for given in by_step:
        rank = given.astype(np.int32)
        model.predict()
        kind = class_of(rank)
        right_1, right_2 = rank == model.guess_1, rank == model.guess_2
        w_2 = model.w_2
        both = model.w_1 + w_2
        start, stop = model.interval(kind, _ONE - both, both)
        stop -= start
        other = ~(right_1 | right_2)
        # An id that an order predicts has the share of that order, to which nothing is added.
        share = np.where(right_2, w_2, np.where(right_1, model.w_1, stop))
        start = np.where(right_2, 0, np.where(right_1, w_2, start))
        bits = kind * other
        within = (rank * other) & ((np.int32(1) << bits) - 1)
        part = span >> _15
        add = part * start.astype(np.uint64)
        span = part * share.astype(np.uint64)
        span >>= bits.astype(np.uint64)
        add += span * within.astype(np.uint64)
        low += add
        carried = np.flatnonzero(low < add)
        if len(carried):
            _carry(out, end[carried] - 1)
        full = np.flatnonzero(span <= _LOW_32)
        if len(full):
            ready = low[full]
            at = end[full]
            out[at] = ready >> _32
            low[full] = ready << _32
            span[full] <<= _32
            end[full] = at + 1
        model.learn(rank, right_1, right_2, kind)
    out[end] = low >> _32
    out[end + 1] = low & _LOW_32
    end += 2
    words = out.astype("<u4", copy=False)
    return [words[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())]


def _carry(out: np.ndarray, at: np.ndarray) -> None:
    """Adds one to the words at the given places, and to those before them that overflow."""
    while len(at):
        out[at] += np.uint32(1)
        at = at[out[at] == 0] - 1


def decode(blocks: list[bytes], length: int) -> np.ndarray:
    """The ranks of each block of a length, one block per row."""
    lanes = len(blocks)
    ranks = np.empty((length, lanes), np.uint16)
    if lanes == 0:
        return ranks.T
    sizes = np.fromiter(map(len, blocks), np.int64, lanes) // 4
    words = np.frombuffer(b"".join(blocks) + b"\0" * 64, "<u4").astype(np.uint32, copy=False)
    at = np.cumsum(sizes) - sizes
    model = _Model(lanes)
    code = (words[at].astype(np.uint64) << _32) | words[at + 1]
    at = at + 2
    last = len(words) - 1
    span = np.full(lanes, 2**64 - 1, np.uint64)
    most = np.uint64(_ONE - 1)
    for t in range(length):
        model.predict()
        w_2 = model.w_2
        both = model.w_1 + w_2
        left = _ONE - both
        part = span >> _15
        share = np.minimum(code // part, most).astype(np.int32)
        right_2 = share < w_2
        other = share >= both
        # The class whose share of what is left holds this place.
        place = np.maximum(share - both, 0)
        place += 1
        place <<= 15
        place -= 1
        place //= left
        below = model.inner <= place.astype(np.uint16)
        kind = np.add.reduce(below.view(np.int8), axis=0, dtype=np.int8).astype(np.int32)
        start, stop = model.interval(kind, left, both)
        stop -= start
        size = np.where(right_2, w_2, np.where(other, stop, model.w_1))
        start = np.where(right_2, 0, np.where(other, start, w_2))
        code -= part * start.astype(np.uint64)
        bits = kind * other
        span = part * size.astype(np.uint64)
        span >>= bits.astype(np.uint64)
        one = np.int32(1) << bits
        within = np.minimum((code // span).astype(np.int64), one - 1)
        code -= span * within.astype(np.uint64)
        guess = np.where(right_2, model.guess_2, model.guess_1)
        rank = np.where(other, one + within.astype(np.int32), guess)
        full = np.flatnonzero(span <= _LOW_32)
        if len(full):
            read = at[full]
            code[full] = (code[full] << _32) | words[np.minimum(read, last)]
            span[full] <<= _32
            at[full] = read + 1
        ranks[t] = rank
        model.learn(rank, rank == model.guess_1, right_2, class_of(rank))
    return ranks.T
