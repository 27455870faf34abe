"""Line dedup by a sharded minimal perfect hash.

All distinct line hashes of the table are indexed: shard by shard a minimal perfect hash numbers
them without gaps, and arrays at these numbers hold a fingerprint and in how many documents the line
is; lines that enough documents hold also have the document that keeps them. Documents probe the
arrays with the hashes of their lines and compare the count with the threshold, so lines are never
joined.

A hash is 128 bits wide. The whole of it places a line; every line that is probed has been indexed,
so the fingerprint, 32 of the bits, is a check of the index and not of the line. Counts are stored as
far as the threshold needs them, a byte each as a rule: an entry takes some six bytes.

The arrays are broadcast while all of them together are within ``BROADCAST_BYTES``. Beyond, the
hashes of lines go to their shard instead, hot shards dealt out by document, and come back by
document. Both ways give the same rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm.storage import Scratch, lean, release_unused, unused, values

BROADCAST_BYTES = 32 << 20
KEYS_PER_SHARD = 250_000
REQUESTS_PER_TASK = 500_000
_KEPT_IN_TASK = 50_000
_PROBED_AT_ONCE = 128
_GAMMA = 2.0  # bits per key on each level
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place(high: np.ndarray, low: np.ndarray, level: int, bits: int) -> np.ndarray:
    seed = np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return _mixed(high ^ _mixed(low + seed)) % np.uint64(bits)


@dataclass
class PerfectHash:
    """Levels of bits; a key's number is the rank of the first bit that it owns alone."""

    levels: list[np.ndarray]  # words of 64 bits

    @classmethod
    def of(cls, high: np.ndarray, low: np.ndarray) -> PerfectHash:
        """Over distinct pairs of uint64."""
        levels = []
        while len(high):
            bits = 64 * math.ceil(_GAMMA * len(high) / 64)
            at = _place(high, low, len(levels), bits)
            taken = np.bincount(at.astype(np.int64), minlength=bits)
            alone = np.packbits(taken == 1, bitorder="little").view(np.uint64)
            levels.append(alone)
            again = taken[at.astype(np.int64)] > 1
            high, low = high[again], low[again]
        return cls(levels)

    def __post_init__(self):
        self.before, total = [], 0
        for words in self.levels:
            ones = np.cumsum(np.bitwise_count(words).astype(np.int64))
            self.before.append(total + np.concatenate([[0], ones[:-1]]).astype(np.int64))
            total += int(ones[-1])

    def numbers(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The number of each key; of a key that was not put in, -1 or any number."""
        out = np.full(len(high), -1, np.int64)
        left = np.arange(len(high))
        for level, (words, before) in enumerate(zip(self.levels, self.before)):
            at = _place(high[left], low[left], level, 64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            own = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[own]] = (before[word] + np.bitwise_count(below))[own]
            left = left[~own]
        return out


class Shard:
    """Arrays of one shard, by the perfect hash's numbers: fingerprints and counts of all lines,
    owners of the repeated ones, in the order of their numbers."""

    SCHEMA = (
        "shard long, level_words binary, levels binary, fingerprints binary, count_bytes long, "
        "counts binary, owners binary"
    )

    def __init__(self, row: dict, least: int):
        sizes = np.frombuffer(row["level_words"], np.int64)
        words = np.frombuffer(row["levels"], np.uint64)
        self.hash = PerfectHash(np.split(words, np.cumsum(sizes)[:-1]))
        self.fingerprints = np.frombuffer(row["fingerprints"], np.uint32)
        self.counts = np.frombuffer(row["counts"], f"<u{row['count_bytes']}")
        self.owners = np.frombuffer(row["owners"], np.int64)
        self.least = least
        self.owner_at = np.cumsum(self.counts >= least, dtype=np.int32) - 1

    @staticmethod
    def built(shard: int, high, low, counts, owners, least: int) -> dict:
        hashed = PerfectHash.of(high, low)
        order = np.argsort(hashed.numbers(high, low))
        kind = next(k for k in (1, 2, 4, 8) if least < 1 << (8 * k))
        counts = np.minimum(counts[order], least)  # more is not asked for
        return {
            "shard": shard,
            "level_words": np.array([len(x) for x in hashed.levels], np.int64).tobytes(),
            "levels": np.concatenate(hashed.levels).tobytes(),
            "fingerprints": _fingerprint(low[order]).tobytes(),
            "count_bytes": kind,
            "counts": counts.astype(f"<u{kind}").tobytes(),
            "owners": owners[order][counts >= least].astype(np.int64).tobytes(),
        }

    def owner_of(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of indexed lines, whether enough documents hold them, and who keeps them then."""
        n = self.hash.numbers(high, low)
        if (n < 0).any() or (self.fingerprints[n] != _fingerprint(low)).any():
            raise ValueError("a line is not in the index of its shard")
        repeated = self.counts[n] >= self.least
        owners = np.zeros(len(n), np.int64)
        owners[repeated] = self.owners[self.owner_at[n[repeated]]]
        return repeated, owners


def _fingerprint(low: np.ndarray) -> np.ndarray:
    return (low & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def line_keys(text: bytes, least: int) -> tuple[list[bytes], list[int], list[bytes]]:
    """The lines, and of those with keys of ``least`` code points or more number and key."""
    lines = text.split(b"\n")
    numbers, keys = [], []
    for k, line in enumerate(lines):
        if len(line) >= least:
            key = line.strip(b" \t\n\x0b\x0c\r").lower()
            if len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least):
                numbers.append(k)
                keys.append(key)
    return lines, numbers, keys


def _hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    import xxhash

    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), ">u8").reshape(-1, 2)
    return both[:, 0].astype(np.uint64), both[:, 1].astype(np.uint64)


_NO_OWNER = np.int64(-(2**63))


def _counted(documents: DataFrame, least: int) -> DataFrame:
    """Lines by hash: how many documents hold them, and the largest id of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen: dict[bytes, list] = {}

        def out() -> pa.RecordBatch:
            both = np.frombuffer(b"".join(seen), ">u8").reshape(-1, 2).astype(np.uint64)
            counts, owners = zip(*seen.values())
            seen.clear()
            columns = [both[:, 0].view(np.int64), both[:, 1].view(np.int64)]
            columns += [np.array(counts, np.int64), np.array(owners, np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(c)) for c in columns], ["high", "low", "n", "owner"]
            )

        for batch in batches:
            for doc_id, text in zip(values(batch.column(0)), values(batch.column(1))):
                owner = _NO_OWNER if doc_id is None else doc_id
                for key in set(line_keys(text or b"", least)[2]):
                    now = seen.setdefault(xxhash.xxh3_128_digest(key), [0, owner])
                    now[0] += 1
                    now[1] = max(now[1], owner)
                if len(seen) > _KEPT_IN_TASK:
                    yield out()
        if seen:
            yield out()

    pairs = _texts(documents).mapInArrow(lean(run), "high long, low long, n long, owner long")
    return pairs.groupBy("high", "low").agg(F.sum("n").alias("n"), F.max("owner").alias("owner"))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")
    )


def _own_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(int(_NO_OWNER)))


def _print() -> Column:
    """Tells rows that share an id, above all those without one, apart by their text."""
    return F.xxhash64(F.col("text").cast("string"))


def _shard_of(high: str, shards: int):
    return F.pmod(F.col(high), F.lit(shards))


def _shards(counted: DataFrame, shards: int, least: int) -> DataFrame:
    def build(table: pa.Table) -> pa.Table:
        column = lambda name: table.column(name).to_numpy()
        row = Shard.built(
            int(column("shard")[0]),
            column("high").astype(np.int64).view(np.uint64),
            column("low").astype(np.int64).view(np.uint64),
            column("n"),
            column("owner"),
            least,
        )
        return pa.table({k: [v] for k, v in row.items()})

    placed = counted.withColumn("shard", _shard_of("high", shards))
    return placed.groupBy("shard").applyInArrow(build, Shard.SCHEMA)


RESULT = "struct<text:string,n_lines:long,n_dropped:long>"
_ARROW_RESULT = pa.struct(
    [("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())]
)


def _without(text: bytes, lines: list[bytes], dropped: set[int]) -> dict:
    """The text without the lines of the given numbers."""
    kept = [x for k, x in enumerate(lines) if k not in dropped] if dropped else None
    return {
        "text": (text if kept is None else b"\n".join(kept)).decode(),
        "n_lines": len(lines),
        "n_dropped": len(dropped),
    }


def _probed_by_broadcast(
    spark: SparkSession, built: DataFrame, shards: int, min_documents: int, least: int
) -> Column:
    rows = [row.asDict() for row in built.collect()]  # within BROADCAST_BYTES
    sent = spark.sparkContext.broadcast(rows)
    opened: dict[int, Shard] = {}

    def lost_lines(high: np.ndarray, low: np.ndarray, owner: np.ndarray) -> np.ndarray:
        lost = np.zeros(len(high), bool)
        order, cuts = _by_shard(high, shards)
        for k, a, b in cuts:
            of = order[a:b]
            repeated, owners = opened[k].owner_of(high[of], low[of])
            lost[of] = repeated & (owners != owner[of])
        return lost

    def probe(doc_ids: pa.Array, texts: pa.Array) -> pa.Array:
        if not opened:
            opened.update({row["shard"]: Shard(row, min_documents) for row in sent.value})
        out = []
        for first in range(0, len(texts), _PROBED_AT_ONCE):
            # Lines of many documents at once.
            some = [x or b"" for x in texts.slice(first, _PROBED_AT_ONCE).to_pylist()]
            found = [line_keys(text, least) for text in some]
            counts = np.fromiter((len(keys) for _, _, keys in found), np.int64, len(found))
            keys = [key for _, _, own in found for key in own]
            lost = np.zeros(0, bool)
            if keys:
                ids = doc_ids.slice(first, _PROBED_AT_ONCE).fill_null(int(_NO_OWNER)).to_numpy()
                lost = lost_lines(*_hashes(keys), np.repeat(ids, counts))
            ends = np.cumsum(counts)
            for text, (lines, numbers, _), a, b in zip(some, found, ends - counts, ends):
                gone = {numbers[k] for k in np.flatnonzero(lost[a:b]).tolist()}
                out.append(_without(text, lines, gone))
        release_unused()
        return pa.array(out, _ARROW_RESULT)

    udf = F.arrow_udf(probe, RESULT)
    return udf(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))


def _by_shard(high: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """An order by shard, and of each shard in it number, start and end."""
    shard = high.view(np.int64) % shards
    order = np.argsort(shard, kind="stable")
    known, first = np.unique(shard[order], return_index=True)
    stops = np.append(first[1:], len(order))
    return order, list(zip(known.tolist(), first.tolist(), stops.tolist()))


def _dropped_by_shuffle(
    documents: DataFrame, built: DataFrame, shards: int, min_documents: int, least: int, salts: int
) -> DataFrame:
    """Per document, by id and ``print`` of its text, the hashes of the lines that it loses, found
    shard by shard."""
    names = ["_id", "print", "high", "low"]

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list] = [[], [], [], []]
            for doc_id, fingerprint, text in zip(*(values(c) for c in batch.columns)):
                keys = list(set(line_keys(text or b"", least)[2]))
                if keys:
                    high, low = _hashes(keys)
                    parts[0].append(np.full(len(keys), doc_id))
                    parts[1].append(np.full(len(keys), fingerprint))
                    parts[2].append(high.view(np.int64))
                    parts[3].append(low.view(np.int64))
            if parts[0]:
                columns = [pa.array(np.concatenate(x)) for x in parts]
                yield pa.RecordBatch.from_arrays(columns, names)

    def probe(asked: pa.Table, arrays: pa.Table) -> pa.Table:
        if not asked.num_rows or not arrays.num_rows:
            return asked.select(names).slice(0, 0)
        shard = Shard(arrays.slice(0, 1).to_pylist()[0], min_documents)
        keys = [asked.column(x).to_numpy().astype(np.int64).view(np.uint64) for x in names[2:]]
        repeated, owners = shard.owner_of(*keys)
        lost = repeated & (owners != asked.column("_id").to_numpy())
        return asked.select(names).filter(pa.array(lost))

    schema = "_id long, print long, high long, low long"
    texts = documents.select(
        _own_id().alias("_id"), _print().alias("print"), F.col("text").cast("string").cast("binary")
    )
    asked = texts.mapInArrow(lean(requests), schema).withColumn("shard", _shard_of("high", shards))
    asked = asked.withColumn("salt", F.pmod(F.xxhash64("_id", "print"), F.lit(salts)))
    copies = built.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumn("salt", F.col("salt").cast("long"))
    lost = (
        asked.groupBy("shard", "salt")
        .cogroup(copies.groupBy("shard", "salt"))
        .applyInArrow(probe, schema)
    )
    one = F.struct("high", "low")
    return lost.groupBy("_id", "print").agg(F.collect_set(one).alias("lost"))


def _removed_by_hash(least: int):
    def remove(texts: pa.Array, lost: pa.Array) -> pa.Array:
        out = []
        for text, pairs in zip(values(texts), values(lost)):
            text = text or b""
            lines, numbers, keys = line_keys(text, least)
            gone: set[int] = set()
            if keys and pairs:
                wanted = {(x["high"], x["low"]) for x in pairs}
                high, low = _hashes(keys)
                hashed = zip(high.view(np.int64).tolist(), low.view(np.int64).tolist())
                gone = {n for n, pair in zip(numbers, hashed) if pair in wanted}
            out.append(_without(text, lines, gone))
        return pa.array(out, _ARROW_RESULT)

    return F.arrow_udf(remove, RESULT)


def dedup_lines(
    documents: DataFrame,
    min_documents: int = 5,
    min_chars: int = 40,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Drops lines that ``min_documents`` rows or more hold, but in the largest ``doc_id``.

    A line's key is the line without ASCII white space at its ends, A-Z in lower case; keys
    shorter than ``min_chars`` code points are left alone. Returns all columns, ``text`` without
    the dropped lines, plus ``n_lines`` (before) and ``n_dropped``. A null or empty text is one
    empty line and becomes the empty text. Rows that share a ``doc_id`` count one by one and keep or
    lose a line alike; a null id is smaller than all others. Columns named like the two new ones are replaced.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "line-dedup")
    counted = scratch.store(_counted(documents, min_chars), "counted")
    shards = max(1, math.ceil(counted.count() / KEYS_PER_SHARD))
    built = scratch.store(_shards(counted, shards, min_documents), "shards")
    scratch.drop("counted")
    columns = [c for c in documents.columns if c not in ("n_lines", "n_dropped")]
    size = sum(F.length(c) for c in ("levels", "fingerprints", "counts", "owners"))
    bytes_built = built.agg(F.sum(size)).first()[0] or 0
    kept_name, id_name, print_name, lost_name = unused(
        documents.columns, "_kept", "_id", "_print", "_lost"
    )
    if bytes_built <= broadcast_bytes:
        probed = _probed_by_broadcast(spark, built, shards, min_documents, min_chars)
        found = documents.withColumn(kept_name, probed)
    else:
        asked = documents.agg(F.sum(F.length(F.col("text").cast("string")))).first()[0] or 0
        salts = max(1, math.ceil(asked / min_chars / shards / REQUESTS_PER_TASK))
        lost = _dropped_by_shuffle(documents, built, shards, min_documents, min_chars, salts)
        lost = lost.toDF(id_name, print_name, lost_name)
        marked = documents.withColumn(id_name, _own_id()).withColumn(print_name, _print())
        joined = marked.join(lost, [id_name, print_name], "left")
        text = F.col("text").cast("string").cast("binary")
        found = joined.withColumn(kept_name, _removed_by_hash(min_chars)(text, F.col(lost_name)))
    result = F.col(kept_name)
    kept = [result["text"].alias("text") if c == "text" else F.col(f"`{c}`") for c in columns]
    return found.select(*kept, result["n_lines"].alias("n_lines"), result["n_dropped"].alias("n_dropped"))
