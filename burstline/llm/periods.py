"""Runs of repeated words, found by internal pattern matching.

A run is a stretch of words with smallest period ``q`` that is at least three times as long and
cannot be made longer. Every run of period ``q`` holds a block of 2^k words, 2^k <= q < 2^(k+1),
that starts at a multiple of 2^k and is found again ``q`` words later inside the run. So:

1. Prefix doubling ranks all blocks of 2^k words, documents apart, and gives a suffix array in
   which the block at a place is an interval. From a length on only what is repeated is sorted.
2. A wavelet tree over the suffix array answers, for the interval of a dyadic block, which
   occurrence comes next after a place (range successor): count what is smaller, then take the
   element of that rank.
3. Occurrences of a block in the window of its own length are an arithmetic progression. One or two
   occurrences are candidate periods as they are. Three or more mean that the block is periodic
   itself, with the progression's difference; then the stretch of that period around the block and
   the one around the occurrences differ, and if there is a longer period, it takes the end of the
   one to the end of the other or the start to the start.
4. A candidate is verified and extended to both sides by the ranks of the doubling. Of stretches
   with equal ends the smallest period counts.

Runs of fewer than 8 words a period are at least 24 words long, so they hold a block of 8 words that
recurs at the next occurrence: shorter blocks are never looked at.

All texts of a batch are taken at once, some millions of bytes of them, a longer text alone. Time
and memory grow with the words times the logarithm of the longest document's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 24  # words
TIMES = 3
_FIRST = 3  # the shortest blocks are of 2^3 words
_BYTES_AT_ONCE = 4 << 20
_BLANK = r"[\x20\x09-\x0D]+"


class _Wavelet:
    """A wavelet matrix: how many values of a range are smaller, and which has a rank there."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(self.bits)):
            ones = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~ones)]))
            values = np.concatenate([values[~ones], values[ones]])

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        count, all_of = np.zeros(len(low), np.int64), high - low
        for zeros, bit in zip(self.zeros, reversed(range(self.bits))):
            a, b = zeros[low], zeros[high]
            one = (than >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            low = np.where(one, zeros[-1] + low - a, a)
            high = np.where(one, zeros[-1] + high - b, b)
        return np.where(than >> self.bits > 0, all_of, count)

    def ranked(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        found, rank = np.zeros(len(low), np.int64), rank.copy()
        for zeros, bit in zip(self.zeros, reversed(range(self.bits))):
            a, b = zeros[low], zeros[high]
            one = rank >= b - a
            rank -= np.where(one, b - a, 0)
            found |= one.astype(np.int64) << bit
            low = np.where(one, zeros[-1] + low - a, a)
            high = np.where(one, zeros[-1] + high - b, b)
        return found

    def successor(self, low, high, least, none: int) -> np.ndarray:
        """The smallest value from ``least`` on in each range; ``none`` if there is none."""
        before = self.smaller(low, high, least)
        inside = before < high - low
        found = np.full(len(low), none, np.int64)
        some = np.flatnonzero(inside)
        found[some] = self.ranked(low[some], high[some], before[some])
        return found


class _Blocks:
    """Ranks of the blocks of 2^k words at each place, documents apart."""

    def __init__(self, words: np.ndarray, begin: np.ndarray, ends: np.ndarray):
        """``words`` are numbers; ``begin`` and ``ends``: where the document of a place does."""
        n = len(words)
        self.begin, self.ends = begin, ends
        self.slot = np.zeros(n, np.int64)  # place in the suffix array
        self.levels: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        rank, size = np.zeros(n, np.int64), np.full(n, n, np.int64)
        # At first documents are told apart and words in them.
        order = np.lexsort((words, ends))
        self._refine(order, [ends, words], rank, size)
        self.levels.append(rank)
        self.sizes.append(size)
        longest = int((ends - np.arange(n)).max()) if n else 0
        while (1 << len(self.levels)) * 2 <= longest:
            k = len(self.levels) - 1
            some = np.flatnonzero(size > 1)
            if not len(some):
                break
            after = some + (1 << k)
            inside = after < ends[some]
            following = np.full(len(some), -1, np.int64)
            following[inside] = rank[after[inside]]
            key = rank[some] * (n + 1) + following + 1
            order = np.argsort(key, kind="stable")
            rank, size = rank.copy(), size.copy()
            self._refine(some[order], [key[order]], rank, size, sorted_keys=True)
            # A block that its document cuts short equals no other.
            self.levels.append(rank)
            self.sizes.append(size)

    def _refine(self, places, keys, rank, size, sorted_keys: bool = False) -> None:
        """Splits the classes of the given places, in order, where a key changes."""
        if not len(places):
            return
        new = np.zeros(len(places), bool)
        new[0] = True
        for key in keys:
            key = key if sorted_keys else key[places]
            new[1:] |= key[1:] != key[:-1]
        # Classes keep to the stretch of the suffix array that their parent had.
        old = rank[places]
        parent = np.concatenate([[True], old[1:] != old[:-1]])
        first = np.flatnonzero(parent)
        within = np.arange(len(places)) - np.repeat(first, np.diff(first, append=len(places)))
        slot = old + within
        self.slot[places] = slot
        starts = np.flatnonzero(new)
        counts = np.diff(starts, append=len(places))
        rank[places] = np.repeat(slot[starts], counts)
        size[places] = np.repeat(counts, counts)

    def _equal(self, k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        rank = self.levels[k]
        return rank[a] == rank[b]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on equal those from ``b`` on, in one document, a < b."""
        return self._common(a, b, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before ``a`` equal those before ``b``."""
        return self._common(a, b, -1)

    def _common(self, a: np.ndarray, b: np.ndarray, way: int) -> np.ndarray:
        total = np.zeros(len(a), np.int64)
        k, top = len(self.levels) - 1, True
        while k >= 0:
            step = 1 << k
            x = a + total if way > 0 else a - total - step
            y = b + total if way > 0 else b - total - step
            can = y + step <= self.ends[b] if way > 0 else x >= self.begin[a]
            some = np.flatnonzero(can)
            right = some[self._equal(k, x[some], y[some])]
            total[right] += step
            if not top or not len(right):  # the longest blocks as often as they fit
                k, top = k - 1, False
        return total


def find_runs(
    words: np.ndarray, lengths: np.ndarray, least: int = LEAST, times: int = TIMES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs, by start and then period. ``words`` are numbers of the
    words of several documents of the given lengths; runs never cross documents."""
    if least < 24 or times < 3:
        raise ValueError("blocks find runs of 24 words or more that hold three periods or more")
    nothing = (np.zeros(0, np.int64),) * 3
    stops = np.cumsum(lengths)
    begin = np.repeat(stops - lengths, lengths)
    ends = np.repeat(stops, lengths)
    n = len(words)
    if not n or lengths.max() < least:
        return nothing
    blocks = _Blocks(words, begin, ends)
    if len(blocks.levels) <= _FIRST:
        return nothing
    # Only places whose first block recurs are ever asked for.
    alive = np.flatnonzero(blocks.sizes[_FIRST] > 1)
    if not len(alive):
        return nothing
    slots = np.sort(blocks.slot[alive])
    by_slot = np.empty(n, np.int64)
    by_slot[blocks.slot[alive]] = alive
    tree, never = _Wavelet(by_slot[slots]), 4 * n
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(_FIRST, len(blocks.levels)):
        size = 1 << k
        rank, sizes = blocks.levels[k], blocks.sizes[k]
        at = alive[(alive - begin[alive]) % size == 0]
        at = at[(sizes[at] > 1) & (at + size <= ends[at])]
        if not len(at):
            continue
        low = np.searchsorted(slots, rank[at])
        high = low + sizes[at]
        if k == _FIRST:
            first = tree.successor(low, high, at + 1, never)
            near = first < at + size
            found.append((at[near], first[near] - at[near]))
        first = tree.successor(low, high, at + size, never)
        near = first < at + 2 * size
        at, low, high, first = at[near], low[near], high[near], first[near]
        second = tree.successor(low, high, first + 1, never)
        more = second < at + 2 * size
        found.append((at[~more], first[~more] - at[~more]))
        at, low, high, first, second = (x[more] for x in (at, low, high, first, second))
        third = tree.successor(low, high, second + 1, never)
        more = third < at + 2 * size
        found.append((at[~more], first[~more] - at[~more]))
        found.append((at[~more], second[~more] - at[~more]))
        at, first, second = at[more], first[more], second[more]
        step = second - first
        # The stretches of the block's own period, around it and around its occurrences.
        from_1 = at - blocks.backward(at, at + step)
        to_1 = at + step + blocks.forward(at, at + step)
        from_2 = first - blocks.backward(first, second)
        to_2 = second + blocks.forward(first, second)
        found.append((at, to_2 - to_1))
        found.append((at, from_2 - from_1))
    if not found:
        return nothing
    at = np.concatenate([x for x, _ in found])
    period = np.concatenate([x for _, x in found])
    sound = (period > 0) & (at + period < ends[at])
    pairs = np.unique(np.stack([at[sound], period[sound]]), axis=1)
    at, period = pairs
    start = at - blocks.backward(at, at + period)
    stop = at + period + blocks.forward(at, at + period)
    length = stop - start
    long = length >= np.maximum(least, times * period)
    order = np.lexsort((period[long], stop[long], start[long]))
    start, stop, period = start[long][order], stop[long][order], period[long][order]
    one = np.ones(len(start), bool)
    one[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[one], stop[one], period[one]
    order = np.lexsort((period, start))
    return start[order], (stop - start)[order], period[order]


def _best(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run that holds its period most often, exactly; the first of equals."""
    best = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_runs", pa.int64()),
        ("runs", pa.list_(_RUN)),
        ("best", _RUN),
        ("collapsed", pa.string()),
    ]
)
FOUND = (
    "struct<n_words: long, n_runs: long, "
    "runs: array<struct<start: long, length: long, period: long>>, "
    "best: struct<start: long, length: long, period: long>, collapsed: string>"
)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of some size; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for k, n in enumerate(sizes.tolist()):
        if k > first and size + n > _BYTES_AT_ONCE:
            yield texts.slice(first, k - first)
            first, size = k, 0
        size += n
    if first < len(texts):
        yield texts.slice(first)


def _collapse(texts: pa.Array, least: int, times: int) -> pa.Array:
    """The runs of some texts, and the texts without what repeats in them."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    values = split.flatten()
    real = np.flatnonzero(pc.not_equal(pc.binary_length(values), 0).to_numpy(zero_copy_only=False))
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    stops = np.searchsorted(real, offsets)  # empty strings stand for white space at the ends
    values = values.take(pa.array(real))
    lengths = np.diff(stops)
    words = values.dictionary_encode().indices.to_numpy().astype(np.int64)
    able = np.repeat(lengths >= least, lengths)
    start, length, period = find_runs(words[able], lengths[lengths >= least], least, times)
    # Back to places among all words.
    places = np.flatnonzero(able)
    start = places[start]
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    owner = np.searchsorted(stops, start, "right") - 1
    inside = np.searchsorted(start, stops)
    rows = list(zip((start - stops[owner]).tolist(), length.tolist(), period.tolist()))
    runs = [rows[a:b] for a, b in zip(inside[:-1].tolist(), inside[1:].tolist())]
    left = np.concatenate([[0], np.cumsum(kept)])[stops]
    remaining = values.filter(pa.array(kept))
    lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), remaining)
    columns = [
        pa.array(lengths, pa.int64()),
        pa.array([len(x) for x in runs], pa.int64()),
        pa.array([[dict(zip(_RUN.names, r)) for r in x] for x in runs], pa.list_(_RUN)),
        pa.array([b and dict(zip(_RUN.names, b)) for b in map(_best, runs)], _RUN),
        pc.binary_join(lists, " "),
    ]
    return pa.StructArray.from_arrays(columns, fields=list(_FOUND))


def runs_of(text: Column | str, least: int = LEAST, times: int = TIMES) -> Column:
    """A struct: ``n_words``; ``n_runs``; ``runs`` with start, length and period in words, by start
    and then period; ``best``, the run that holds its period most often (null without runs); and
    ``collapsed``, the words joined by one space without those that a run repeats after its first
    period. Words are what stands between ASCII white space. Null and empty texts have no words,
    no runs and collapse to an empty text."""

    def run(texts: pa.Array) -> pa.Array:
        parts = [_collapse(x, least, times) for x in _slices(texts.cast(pa.string()))]
        return pa.concat_arrays(parts) if parts else pa.array([], _FOUND)

    return F.arrow_udf(run, FOUND)(text)


def collapse_runs(
    documents: DataFrame, text: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """All rows with ``n_words``, ``n_runs``, ``runs``, ``best`` and ``collapsed`` of
    :func:`runs_of`. Columns of those names are replaced, all others stay as they are; equal rows
    and rows with equal or null ids have results of their own."""
    row = documents.select(F.struct("*").alias("row"), runs_of(F.col(text), least, times).alias("found"))
    results = ["n_words", "n_runs", "runs", "best", "collapsed"]
    stay = [F.col("row").getField(c).alias(c) for c in documents.columns if c not in results]
    return row.select(*stay, *(F.col("found").getField(c).alias(c) for c in results))


def planted(documents: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``. In one document of ten, by a checksum of its id, the words from a
    place on repeat the first of them, so that there are long and short periods to be found: with
    h = crc32(doc_id), g = h / 10 and n words, word i from a = g % n on is word a + (i - a) % p,
    p = 1 + (n - a) / (3 + g % 8). Documents without id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    chosen = F.col("chosen")
    words = F.filter(F.split("text", _BLANK.replace("\\x20", " ")), lambda w: w != "")
    split = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("chosen", F.when(h % 10 == 0, words))
    n = F.size("chosen").cast("long")
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
    text = F.array_join(
        F.transform(
            chosen, lambda w, i: F.when(i < a, w).otherwise(F.get(chosen, a + F.pmod(i - a, p)))
        ),
        " ",
    )
    return split.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))
