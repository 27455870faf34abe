"""Exact top-k search: BM25 over a sharded inverted index, pruned by bounds of single documents.

Documents are dealt to shards by a hash of their id, one task per shard. The task builds its index
and answers all queries, which it reads from the shared folder a few at a time: its memory does not
grow with their number, and queries are not shuffled to every shard.

1. In a shard, documents with the same frequent words (a language, a subject) are of one kind, found
   by the cosine to centers. Each kind has an index of its own, so that few words are frequent in it.
2. Lists of frequent words are laid out as rows, an impact or zero for each document. A product of
   matrices gives, for some queries at a time, what all these lists together give to each document.
   Queries with few of these words, as those in another language, only read the rows they have.
3. The other lists are short; they are walked through and added. All of this is in single precision
   and rounded up, so it is a bound for the score of each document, though a close one.
4. Documents are scored in full in descending order of their bounds, from their own list of words,
   until no bound reaches the k-th best score, which rises on the way.

A part of the shards is asked first. The k-th best of its scores is a threshold that all others know
from the start, so there only documents that reach it are looked at. Counts of documents, words and
documents per term are those of the whole table, so scores of all shards compare, and the merged
result is the exact top k.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burstline.llm.minhash import word_hashes
from burstline.llm.storage import Scratch, lean, release_unused, values

K1, B = 1.2, 0.75
BYTES_PER_SHARD = 64 << 20
FIRST = 8  # one of so many shards is asked first, if there are twice as many
FREQUENT = 12  # lists with more than one of so many documents are laid out as rows
FREQUENT_BYTES = 64 << 20  # of all rows; lists beyond stay inverted
FEW = 40  # a query with at most one of so many of the rows does not read the others
SEED_POSTINGS = 1 << 15  # walked through together
BLOCK = 64  # documents and k more from which on some are scored for a threshold
PRODUCT_BYTES = 24 << 20  # of the bounds of the queries taken together
QUERIES_AT_ONCE = 256
KINDS, KIND_WORDS, KIND_TURNS = 8, 256, 6
LEAST_KIND = 500  # documents
DECIMALS = 6  # scores are rounded to; equal scores rank by id
MARGIN = 10.0**-DECIMALS  # rounding moves a score by half of it at most
_LOW = 0 if sys.byteorder == "little" else 1  # half of a number of 64 bits


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")
    )


def _asked(queries: DataFrame) -> DataFrame:
    """The words of each query, their hashes and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for query, text in zip(values(batch.column(0)), values(batch.column(1))):
                words = (text or b"").lower().split()
                counts = Counter(words)
                hashes = dict(zip(words, word_hashes(text or b"").view(np.int64).tolist()))
                rows += [(query, w.decode(), hashes[w], n) for w, n in counts.items()]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["query_id", "word", "term", "n"]
            )

    found = _texts(queries).mapInArrow(run, "query_id long, word string, term long, n long")
    found = found.filter(F.col("query_id").isNotNull())
    return found.groupBy("query_id", "word", "term").agg(F.sum("n").alias("n"))


def _held(texts: DataFrame) -> DataFrame:
    """How many documents hold a term, in parts; with a null term, all documents and words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, words = [], 0
            for text in values(batch.column("text")):
                hashes = word_hashes(text or b"")
                words += len(hashes)
                terms.append(np.unique(hashes))
            known, counts = np.unique(np.concatenate(terms), return_counts=True)
            columns = [
                pa.array([*known.view(np.int64).tolist(), None], pa.int64()),
                pa.array([*counts.tolist(), len(terms)], pa.int64()),
                pa.array([None] * len(known) + [words], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["term", "n", "words"])

    return texts.select("text").mapInArrow(run, "term long, n long, words long")


def _counted(text: bytes | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the different words of a text, how often each occurs, and how many words there are."""
    hashes = word_hashes(text or b"")
    terms, counts = np.unique(hashes, return_counts=True)
    return terms, counts.astype(np.int32), len(hashes)


def _joined(arrays: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones, sorted, and the number of each; with less memory than ``np.unique``."""
    terms = np.sort(hashes)
    terms = terms[np.concatenate([[True], terms[1:] != terms[:-1]])] if len(terms) else terms
    numbers = np.empty(len(hashes), np.int32)
    for k in range(0, len(hashes), 1 << 18):
        numbers[k : k + (1 << 18)] = np.searchsorted(terms, hashes[k : k + (1 << 18)])
    return terms, numbers


class Index:
    """The words of documents, rows of impacts for the lists of frequent words, and inverted lists of
    the others. Documents are numbered by id."""

    def __init__(self, ids: np.ndarray, texts: list[bytes | None], mean: float):
        """``mean``: the words per document of the whole table."""
        terms, counts, lengths = zip(*map(_counted, texts)) if texts else ((), (), ())
        sizes = np.fromiter(map(len, terms), np.int64, len(terms))
        norms = K1 * (1 - B + B * np.array(lengths, np.float64) / mean)
        self.terms, word = _numbered(_joined(terms, np.uint64))
        self._fill(ids, word, _joined(counts, np.int32), sizes, norms)

    @classmethod
    def of(cls, ids, terms, word, tf, sizes, norms) -> Index:
        """The same of words that are numbered: sorted hashes, and of each document its words, how
        often each occurs, how many these are, and its norm."""
        own = cls.__new__(cls)
        own.terms = terms
        own._fill(ids, word, tf, sizes, norms)
        return own

    def _fill(self, ids, word, tf, sizes, norms) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, starts = ids[order], (np.cumsum(sizes) - sizes)[order]
        sizes, self.norms = sizes[order], norms[order]
        if (np.diff(order) != 1).any():
            at = _ranges(starts, starts + sizes)
            word, tf = word[at], tf[at]
            del at
        # By document: the words, and how often each occurs.
        self.begin = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        self.word = word
        self.tf = tf.astype(np.uint16) if tf.max(initial=0) < 1 << 16 else tf
        self.sizes = np.bincount(word, minlength=len(self.terms))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        # Of the words of the query at hand.
        self.weight, self.wanted = np.zeros(len(self.terms)), np.zeros(len(self.terms), bool)
        self._lay_out()
        self.room = np.empty((0, len(self.ids)), np.float32)
        # Postings looked at one by one, so not in products, and of all lists of the queries.
        self.touched = self.asked = 0

    def _impacts(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        tf = self.tf[at].astype(np.float64)
        return tf * (K1 + 1) / (tf + self.norms[doc])

    def _lay_out(self) -> None:
        """One row of impacts, zero where a document has none, for each list of a frequent word, and
        the documents and impacts of the other lists."""
        documents = max(len(self.ids), 1)
        frequent = np.flatnonzero(self.sizes * FREQUENT > documents)
        room = FREQUENT_BYTES // (4 * documents)
        if len(frequent) > room:
            frequent = np.sort(frequent[np.argsort(-self.sizes[frequent], kind="stable")[:room]])
        self.row = np.full(len(self.terms), -1, np.int32)
        self.row[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), len(self.ids)), np.float32)
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), np.diff(self.begin))
        row = self.row[self.word]
        at = np.flatnonzero(row >= 0)
        self.rows[row[at], doc[at]] = self._impacts(at, doc[at])
        # A sum of so many products without negative ones is at most this much too small.
        self.above = np.float32(1 + (len(frequent) + 4) * 2.0**-23)
        at = np.flatnonzero(row < 0)
        del row
        at = at[np.argsort(self.word[at], kind="stable")]
        # A posting is the document and its impact, the bits of a float.
        self.postings = doc[at].astype(np.uint64) << np.uint64(32)
        for k in range(0, len(at), SEED_POSTINGS):
            some = at[k : k + SEED_POSTINGS]
            impact = self._impacts(some, doc[some]).astype(np.float32)
            self.postings[k : k + SEED_POSTINGS] |= impact.view(np.uint32)
        self.start = np.concatenate([[0], np.cumsum(np.where(self.row < 0, self.sizes, 0))])

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether there is a list of each hash, and its number."""
        if not len(self.terms):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int32)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return self.terms[at] == hashes, at.astype(np.int32)

    def top(self, lists: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k best (score, id) of documents with any of these lists, best first."""
        return next(self.tops([(lists, weights)], k))

    def tops(
        self, asked: list[tuple[np.ndarray, np.ndarray]], k: int
    ) -> Iterator[list[tuple[float, int]]]:
        """The same for the lists and weights of each of several queries."""
        yield from Shard([self]).tops([asked], [-math.inf] * len(asked), k)

    def bounds(self, asked: list[tuple[np.ndarray, np.ndarray]], most: np.ndarray) -> None:
        """Into ``most``: for the lists and weights of each query, what they give to each document, and
        a little more, as much as rounding may take away."""
        sizes = np.fromiter((len(lists) for lists, _ in asked), np.int64, len(asked))
        lists = _joined([x for x, _ in asked], np.int32)
        weights = _joined([x for _, x in asked], np.float64).astype(np.float32)
        query = np.repeat(np.arange(len(asked)), sizes)
        self.asked += int(self.sizes[lists].sum())
        row = self.row[lists]
        at = np.flatnonzero(row >= 0)
        factors = np.zeros((len(asked), len(self.rows)), np.float32)
        factors[query[at], row[at]] = weights[at]
        few = np.bincount(query[at], minlength=len(asked)) * FEW <= len(self.rows)
        own, others = np.flatnonzero(few), np.flatnonzero(~few)
        used = np.flatnonzero(factors[own].any(axis=0))
        if len(others) == len(asked) or 2 * len(used) > len(self.rows):
            np.matmul(factors, self.rows, out=most)
        else:
            most[own] = self._product(factors[np.ix_(own, used)], self.rows[used])
            most[others] = self._product(factors[others], self.rows)
        at = np.flatnonzero(row < 0)
        lists, weights, query = lists[at], weights[at], query[at]
        starts = self.start[lists]
        lengths = self.start[lists + 1] - starts
        self.touched += int(lengths.sum())
        # So many postings at a time, and those of one query together.
        edges = np.arange(SEED_POSTINGS, int(lengths.sum()), SEED_POSTINGS)
        edges = [0, *np.searchsorted(np.cumsum(lengths), edges).tolist(), len(lists)]
        for a, b in zip(edges, edges[1:]):
            own = lengths[a:b]
            found = self.postings.take(_ranges(starts[a:b], starts[a:b] + own), mode="clip")
            given = found.view(np.float32)[_LOW::2] * np.repeat(weights[a:b], own)
            found >>= np.uint64(32)
            for q, x, y in _runs(query[a:b], own):
                np.add.at(most[q], found[x:y].view(np.int64), given[x:y])
        most *= self.above * np.float32(1 + (int(sizes.max(initial=0)) + 4) * 2.0**-23)

    def _product(self, factors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """In memory that the next call takes again."""
        if len(self.room) < len(factors):
            self.room = np.empty((len(factors), len(self.ids)), np.float32)
        return np.matmul(factors, rows, out=self.room[: len(factors)])

    def _partial(self, lists: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What some lists give to each document."""
        self.touched += int(self.sizes[lists].sum())
        weight = np.zeros(len(self.terms))
        weight[lists] = weights
        doc = np.repeat(np.arange(len(self.ids)), np.diff(self.begin))
        given = weight[self.word] * self._impacts(np.arange(len(self.word)), doc)
        return np.bincount(doc, given, len(self.ids))

    def scores(self, lists: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Full scores of some documents."""
        self.weight[lists], self.wanted[lists] = weights, True
        try:
            return self._scores(docs)
        finally:
            self.weight[lists], self.wanted[lists] = 0, False

    def _scores(self, docs: np.ndarray) -> np.ndarray:
        """Full scores, from the words of each document."""
        starts, stops = self.begin[docs], self.begin[docs + 1]
        spans = [slice(*span) for span in zip(starts.tolist(), stops.tolist())]
        if not spans:
            return np.zeros(0)
        word = np.concatenate([self.word[span] for span in spans])
        asked = np.flatnonzero(self.wanted[word])
        self.touched += len(asked)
        ends = np.cumsum(stops - starts)
        owner = np.searchsorted(ends, asked, "right")
        at = asked + (stops - ends)[owner]
        given = self.weight[word[asked]] * self._impacts(at, docs[owner])
        return np.round(np.bincount(owner, given, len(docs)), DECIMALS)


def _ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    sizes = stops - starts
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))


def _runs(owner: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Of things with an owner, sorted by it, and a size: each owner and the range of its own."""
    if not len(owner):
        return
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    edges = np.concatenate([[0], np.cumsum(sizes)])
    ends = edges[np.append(first[1:], len(owner))]
    yield from zip(owner[first].tolist(), edges[first].tolist(), ends.tolist())


def kinds(word: np.ndarray, sizes: np.ndarray, terms: int) -> np.ndarray:
    """The kind of each document, so that those of a kind have the same frequent words: a language, a
    subject, a length. Found by the cosine to centers, which are means of their documents."""
    documents = len(sizes)
    if documents < 2 * LEAST_KIND:
        return np.zeros(documents, np.int64)
    often = np.bincount(word, minlength=terms)
    often = np.argsort(-often, kind="stable")[:KIND_WORDS]
    number = np.full(terms, -1, np.int32)
    number[often] = np.arange(len(often))
    number = number[word]
    at = np.flatnonzero(number >= 0)
    has = np.zeros((documents, len(often)), np.float32)
    has[np.repeat(np.arange(documents), sizes)[at], number[at]] = 1
    has /= np.maximum(np.sqrt(has.sum(axis=1, keepdims=True)), 1)
    some = has[:: max(1, documents // 512)]
    some = some[some.any(axis=1)]
    if not len(some):
        return np.zeros(documents, np.int64)
    # Each center to begin with is the document least like those before.
    chosen, like = [], some @ some.sum(axis=0)
    for _ in range(min(KINDS, len(some))):
        chosen.append(int(np.argmin(like)) if chosen else int(np.argmax(like)))
        own = some @ some[chosen[-1]]
        like = np.maximum(like, own) if len(chosen) > 1 else own
    centers = some[chosen]
    for turn in range(KIND_TURNS + 1):
        label = np.argmax(has @ centers.T, axis=1)
        sizes_of = np.bincount(label, minlength=len(centers))
        if turn == KIND_TURNS:
            break
        if turn == KIND_TURNS - 1:
            least = max(LEAST_KIND, documents // 32)
            large = np.flatnonzero(sizes_of >= least)
            centers = centers[large if len(large) else [int(np.argmax(sizes_of))]]
            continue
        sums = np.stack([has[label == c].sum(axis=0) for c in range(len(centers))])
        length = np.sqrt(np.square(sums).sum(axis=1, keepdims=True))
        centers = np.where(length > 0, sums / np.maximum(length, 1e-9), centers)
    return label


class Shard:
    """Indexes of documents of a kind each, asked together."""

    def __init__(self, indexes: list[Index]):
        self.indexes = indexes
        self.terms = indexes[0].terms
        if len(indexes) > 1:
            self.terms = np.unique(np.concatenate([x.terms for x in indexes]))
        self.lists = []
        for index in indexes:
            own = np.full(len(self.terms), -1, np.int32)
            own[np.searchsorted(self.terms, index.terms)] = np.arange(len(index.terms))
            self.lists.append(own)
        bits = max(1, len(self.terms).bit_length())
        self.shift = np.uint64(64 - bits)
        leading = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.leading = np.minimum(np.searchsorted(self.terms, leading), max(len(self.terms) - 1, 0))

    @classmethod
    def of(cls, ids: np.ndarray, terms: list, counts: list, lengths: list, mean: float) -> Shard:
        """Of documents, hashes and counts of the words of each, which are taken out of the lists."""
        sizes = np.fromiter(map(len, terms), np.int64, len(terms))
        norms = K1 * (1 - B + B * np.array(lengths, np.float64) / mean)
        hashes = _joined(terms, np.uint64)
        terms.clear()
        terms, word = _numbered(hashes)
        del hashes
        tf = _joined(counts, np.int32)
        counts.clear()
        label = kinds(word, sizes, len(terms))
        begin, indexes = np.cumsum(sizes) - sizes, []
        for kind in np.unique(label).tolist():
            own = np.flatnonzero(label == kind)
            at = _ranges(begin[own], begin[own] + sizes[own])
            has = np.bincount(word[at], minlength=len(terms)) > 0
            number = (np.cumsum(has) - 1).astype(np.int32)
            indexes.append(
                Index.of(ids[own], terms[has], number[word[at]], tf[at], sizes[own], norms[own])
            )
        return cls(indexes)

    def known(self, terms: list[np.ndarray], weights: list[np.ndarray]) -> list[list[tuple]]:
        """For each index, the lists and weights of each query."""
        sizes = np.fromiter(map(len, terms), np.int64, len(terms))
        ends = np.cumsum(sizes)
        found, at = self._found(_joined(terms, np.uint64))
        weight, out = _joined(weights, np.float64)[found], []
        before = np.concatenate([[0], np.cumsum(found)])
        starts, ends = before[ends - sizes], before[ends]
        for lists in self.lists:
            own = lists[at]
            has = np.flatnonzero(own >= 0)
            lists_of, weights_of = own[has], weight[has]
            spans = zip(np.searchsorted(has, starts).tolist(), np.searchsorted(has, ends).tolist())
            out.append([(lists_of[a:b], weights_of[a:b]) for a, b in spans])
        return out

    def _found(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is there, and the numbers of those that are."""
        if not len(self.terms):
            return np.zeros(len(hashes), bool), np.zeros(0, np.int64)
        # The first term with these leading bits, and then, as hashes are even, few steps.
        at = self.leading[(hashes >> self.shift).astype(np.int64)]
        below = np.arange(len(hashes))
        for _ in range(8):
            below = below[self.terms[at[below]] < hashes[below]]
            at[below] += 1
            below = below[at[below] < len(self.terms)]
        rest = below[self.terms[at[below]] < hashes[below]]
        at[rest] = np.searchsorted(self.terms, hashes[rest])
        np.minimum(at, len(self.terms) - 1, out=at)
        found = self.terms[at] == hashes
        return found, at[found]

    def tops(
        self, asked: list[list[tuple]], enough: list[float], k: int
    ) -> Iterator[list[tuple[float, int]]]:
        """For each query, the (score, id) of its k best documents, if they reach ``enough``. ``asked``
        has for each index the lists and weights of each query."""
        documents = sum(len(x.ids) for x in self.indexes)
        step = max(1, min(len(enough), PRODUCT_BYTES // (4 * max(documents, 1))))
        room = [np.empty((step, len(x.ids)), np.float32) for x in self.indexes]
        for start in range(0, len(enough), step):
            some = [x[start : start + step] for x in asked]
            least = np.maximum(np.array(enough[start : start + step]) - MARGIN, 0)
            most = [x[: len(least)] for x in room]
            reached = np.zeros(len(least), bool)
            for index, own, bounds in zip(self.indexes, some, most):
                index.bounds(own, bounds)
                largest = bounds.max(axis=1, initial=0)
                reached |= (largest > 0) & (largest >= least)
            for n in range(len(least)):
                if not reached[n]:
                    yield []
                    continue
                bounds = [x[n] for x in most]
                yield self._best([x[n] for x in some], bounds, enough[start + n], k)

    def _best(self, asked: list[tuple], most: list[np.ndarray], enough: float, k: int) -> list[tuple]:
        """Documents are scored in descending order of ``most``, until it is below the k-th best."""
        edges = np.cumsum([0, *map(len, most)])
        most = np.concatenate(most)
        least, first = max(enough - MARGIN, 0), np.zeros(0, np.int64)
        best, ids = np.zeros(0), np.zeros(0, np.int64)
        if enough <= 0 and len(most) > BLOCK + k:  # some for a threshold
            first = np.argpartition(most, len(most) - k)[len(most) - k :]
            best, ids = self._merged(asked, edges, first[most[first] > 0], best, ids, enough, k)
            least = max(least, best[-1] - MARGIN) if len(best) == k else least
            most[first] = 0
        able = np.flatnonzero((most > 0) & (most >= least))
        able = able[np.argsort(-most[able], kind="stable")]
        done, width = 0, k
        while done < len(able) and most[able[done]] >= least:
            some = able[done : done + width]
            some = some[most[some] >= least]
            best, ids = self._merged(asked, edges, some, best, ids, enough, k)
            least = max(least, best[-1] - MARGIN) if len(best) == k else least
            done, width = done + width, 2 * width
        return list(zip(best.tolist(), ids.tolist()))

    def _merged(self, asked, edges, docs, best, ids, enough: float, k: int):
        """The k best of some and of these documents, whose number counts through the indexes."""
        for index, own, a, b in zip(self.indexes, asked, edges, edges[1:]):
            some = docs[(docs >= a) & (docs < b)] - a
            if len(some):
                best = np.concatenate([best, index.scores(*own, some)])
                ids = np.concatenate([ids, index.ids[some]])
        order = np.lexsort((ids, -best))
        order = order[(best[order] > 0) & (best[order] >= enough)][:k]
        return best[order], ids[order]


_FOUND = pa.schema(
    [
        ("query_id", pa.int64()),
        ("hits", pa.list_(pa.struct([("score", pa.float64()), ("doc_id", pa.int64())]))),
    ]
)


def _queries(root: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """Id, hashes, weights and threshold of each query of a stored table, few in memory at a time."""
    system, folder = fs.FileSystem.from_uri(root)
    for info in system.get_file_info(fs.FileSelector(folder)):
        if not info.base_name.endswith(".parquet") or info.base_name[0] in "_.":
            continue
        with system.open_input_file(info.path) as source:
            file = pq.ParquetFile(source, buffer_size=1 << 20)
            for batch in file.iter_batches(QUERIES_AT_ONCE, use_threads=False):
                ids, enough = (batch.column(x).to_pylist() for x in ("query_id", "enough"))
                asked = batch.column("asked")
                edges = asked.offsets.to_pylist()
                term = asked.values.field("term").to_numpy().view(np.uint64)
                idf = asked.values.field("idf").to_numpy()
                for query, least, a, b in zip(ids, enough, edges, edges[1:]):
                    yield query, term[a:b], idf[a:b], least


def _answered(index: Index | Shard, queries: Iterator, k: int) -> Iterator[pa.RecordBatch]:
    """The hits of a shard for each query with a word in it, in small batches. After a query's id,
    hashes and weights may come a threshold."""
    shard = index if isinstance(index, Shard) else Shard([index])

    def found(some: list[tuple]) -> pa.RecordBatch:
        names, terms, weights, *enough = zip(*some) if some else ((), (), ())
        asked = shard.known(terms, weights)
        enough = enough[0] if enough else [-math.inf] * len(names)
        rows = [
            {"query_id": name, "hits": [{"score": score, "doc_id": doc} for score, doc in hits]}
            for name, hits in zip(names, shard.tops(asked, enough, k))
            if hits
        ]
        return pa.RecordBatch.from_pylist(rows, _FOUND)

    some = []
    for query in queries:
        some.append(query)
        if len(some) == QUERIES_AT_ONCE:
            yield found(some)
            some = []
    yield found(some)


def _searched(placed: DataFrame, shards: int, root: str, mean: float, k: int) -> DataFrame:
    """The hits of each shard for the queries stored at ``root``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, counts, lengths = [], [], [], []
        for batch in batches:
            ids += batch.column("doc_id").to_pylist()
            for found, tf, words in map(_counted, values(batch.column("text"))):
                terms.append(found)
                counts.append(tf)
                lengths.append(words)
        if not ids:
            return
        shard = Shard.of(np.array(ids, np.int64), terms, counts, lengths, mean)
        del ids, lengths
        release_unused()
        yield from _answered(shard, _queries(root), k)

    hits = "query_id long, hits array<struct<score:double,doc_id:long>>"
    # A shard is a partition, so a task has one and not what a hash of its number deals to it.
    dealt = placed.repartitionById(shards, F.col("shard").cast("int"))
    return dealt.select("doc_id", "text").mapInArrow(lean(run), hits)


def _least(found: DataFrame, k: int) -> DataFrame:
    """The k-th best score of the shards asked, a bound for the k-th best of all."""
    scores = F.sort_array(F.flatten(F.collect_list("hits.score")), asc=False)
    least = F.coalesce(F.get(scores, F.lit(k - 1)), F.lit(0.0))
    return found.groupBy("query_id").agg(least.alias("enough"))


def search(
    queries: DataFrame, documents: DataFrame, k: int = 10, query_terms: int | None = None
) -> DataFrame:
    """``query_id``, ``rank``, ``doc_id``, ``score``: the k best documents of each query.

    Both tables have ``doc_id`` and ``text``. Words are what stands between ASCII white space,
    A-Z in lower case. A query is the set of its words, or with ``query_terms`` so many of them,
    those of the largest count times idf, equal ones in the order of the words. Equal scores rank
    by id. Documents without a word of the query are no result; null and empty texts match
    nothing but count as documents. Rows that share an id are one query, but documents of their
    own; rows without id are neither asked nor found, but count. Other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "bm25")
    texts = _texts(documents)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / BYTES_PER_SHARD))
    placed = texts.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))

    asked = scratch.store(_asked(queries), "asked")
    held = _held(texts).groupBy("term").agg(F.sum("n").alias("df"), F.sum("words").alias("words"))
    held = scratch.store(held, "held")
    scratch.release()
    counts = held.filter(F.col("term").isNull()).agg(F.sum("df"), F.sum("words")).first()
    total, words = counts[0] or 0, counts[1] or 0
    idf = F.log(1 + (F.lit(total) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = asked.join(held.select("term", "df"), "term").withColumn("idf", idf)
    if query_terms is not None:
        weight = F.round(F.col("n") * F.col("idf"), 9).desc()
        order = Window.partitionBy("query_id").orderBy(weight, "word")
        weighted = weighted.withColumn("place", F.row_number().over(order))
        weighted = weighted.filter(F.col("place") <= query_terms)
    terms = F.collect_list(F.struct("term", "idf")).alias("asked")
    weighted = weighted.groupBy("query_id").agg(terms)
    weighted = scratch.store(weighted.withColumn("enough", F.lit(0.0)), "weighted")
    scratch.drop("asked", "held")
    scratch.release()

    known = placed.filter(F.col("doc_id").isNotNull())
    mean, first = max(words, 1) / max(total, 1), shards // FIRST if shards >= 2 * FIRST else 0
    parts, root = [], "weighted"
    if first:
        some = known.filter(F.col("shard") < first)
        parts.append(scratch.store(_searched(some, first, scratch.path(root), mean, k), "first"))
        scratch.release()
        weighted = weighted.drop("enough").join(_least(parts[0], k), "query_id", "left")
        scratch.store(weighted.fillna(0.0, "enough"), root := "bounded")
        scratch.drop("weighted")
        known = known.filter(F.col("shard") >= first).withColumn("shard", F.col("shard") - first)
    parts.append(scratch.store(_searched(known, shards - first, scratch.path(root), mean, k), "found"))
    scratch.release()
    found = reduce(DataFrame.union, parts)
    hits = F.filter("hits", lambda x: x["score"] >= F.col("enough"))
    found = found.join(_least(found, k), "query_id").select("query_id", F.inline(hits))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "doc_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("long"), "doc_id", "score")
