"""MinHash near-dedup with circulant permutations.

Two permutations of a universe of 2^32 make all coordinates of a signature: the first places the
shingles, the second, shifted circularly by k, gives coordinate k. Bands of the signature are
bucket keys; documents that share a bucket are compared on their full shingle sets.

Equal sets are one class, so copies cost nothing. Not all pairs of a bucket are compared:

1. every class with the smallest class of its buckets, one comparison per class;
2. in buckets that still hold several components, every class with the bucket's smallest and
   with any class of its largest component, unless they are in one component already;
3. in buckets that still do, every class outside the bucket's largest component with all others
   that are not in its own, if sizes and sketches allow the similarity. Where that would be many
   pairs, as for pages of one template that differ in the rest, classes are compared by prefix
   instead: two sets that are similar enough have one of their rarest shingles in common, of
   each as many as a similar set may lack, and one more. So a bucket costs what is shared by few.

Only pairs already known to be connected are left out, so no link is lost that would join
components. A sketch is one bit of each coordinate of a longer signature, made from the same two
permutations by further shifts, for the classes of step 3 only. It is asked for less than the
threshold: a pair at 0.75 fails if it is off by four and a half standard deviations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.components import components
from burstline.llm.storage import Scratch, lean, release_unused, values

WORDS = 5
BANDS, ROWS = 32, 4
COORDINATES = BANDS * ROWS
SKETCHED = 2048
SKETCH_WORDS = SKETCHED // 64
_DEVIATIONS = 4.5
HOT_PAIRS = 20_000  # of a bucket, from which on it is compared by prefix
_SLOTS = 1 << 20  # counters for the frequency of shingles
_PRIME = np.uint64(0x100000001B3)
_CELLS = 1 << 18  # values of shifted permutations held at a time


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: what stands between ASCII white space, A-Z in lower case."""
    data = np.frombuffer(text.lower(), np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _PRIME, np.uint64))
    value = _mixed(data[inside].astype(np.uint64) + np.uint64(1)) * power[at]
    return _mixed(np.add.reduceat(value, first))


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Distinct shingles as sorted 64-bit hashes; fewer words than asked for are one shingle."""
    found = word_hashes(text or b"")
    if not len(found):
        return found
    n = min(words, len(found))
    count = len(found) - n + 1
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out = _mixed(out * _PRIME + found[k : k + count])
    return np.unique(out)


def signature(items: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """Circulant MinHash: the least value of each shifted permutation over the set."""
    placed = (_mixed(items) >> np.uint64(32)).astype(np.uint32)  # the first permutation
    least = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    shifts = np.arange(coordinates, dtype=np.uint32)
    at_once = _CELLS // coordinates
    for first in range(0, len(placed), at_once):
        x = placed[first : first + at_once, None] + shifts  # modulo 2^32: a circular shift
        x ^= x >> np.uint32(16)  # the second permutation, a bijection of the universe
        x *= np.uint32(0x7FEB352D)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x846CA68B)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(0), out=least)
    return least


def _band_keys(sign: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64)
    for column in sign.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = _mixed(key * _PRIME + column)
    return key.view(np.int64)


def _sketch(sign: np.ndarray) -> np.ndarray:
    """One bit of each coordinate, 64 to a word."""
    return np.packbits((sign & np.uint32(1)).astype(bool), bitorder="little").view(np.int64)


SIGNED = "doc_id long, n_shingles long, set_high long, set_low long, bands array<long>"


def signed(documents: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document the size and a 128-bit hash of its shingle set, bucket keys. An empty
    set has no keys."""
    names = [x.split()[0] for x in SIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            sizes, highs, lows, bands = [], [], [], []
            for text in values(batch.column("text")):
                items = shingles(text, words)
                whole = xxhash.xxh3_128_intdigest(items.tobytes())
                sizes.append(len(items))
                highs.append((whole >> 64) - (1 << 63))
                lows.append((whole & (2**64 - 1)) - (1 << 63))
                bands.append(_band_keys(signature(items)) if len(items) else [])
            columns = [batch.column("doc_id")]
            columns += [pa.array(x, pa.int64()) for x in (sizes, highs, lows)]
            columns.append(pa.array(bands, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names)

    return _texts(documents).mapInArrow(lean(run), SIGNED)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")
    )


def _sets(documents: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """Full shingle sets of the documents that are compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(text, words).tobytes() for text in values(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "items"]
            )

    chosen = _texts(documents).join(ids, "doc_id", "left_semi")
    return chosen.mapInArrow(lean(run), "doc_id long, items binary")


# Columns of their own: comparing two rows then compiles to a few instructions per word.
_WORDS_OF_SKETCH = [f"s{k}" for k in range(SKETCH_WORDS)]


def _sketches(sets: DataFrame, reps: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = (np.frombuffer(x, np.uint64) for x in values(batch.column("items")))
            found = np.array([_sketch(signature(x, SKETCHED)) for x in items], np.int64)
            words = np.ascontiguousarray(found.reshape(-1, SKETCH_WORDS).T)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), *map(pa.array, words)], ["rep", *_WORDS_OF_SKETCH]
            )

    chosen = sets.withColumnRenamed("doc_id", "rep").join(reps, "rep", "left_semi")
    schema = ", ".join(f"{name} long" for name in ["rep", *_WORDS_OF_SKETCH])
    return chosen.mapInArrow(lean(run), schema)


def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(values(a), values(b)):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        at = np.minimum(np.searchsorted(x, y), len(x) - 1)
        out.append(int((x[at] == y).sum()))
    release_unused()
    return pa.array(out, pa.int64())


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. The larger id, which has few
    pairs, brings its set first, so that sets travel once per pair."""
    of = lambda x: sets.select(F.col("doc_id").alias(x), F.col("items").alias(f"items_{x}"))
    joined = pairs.join(of("b"), "b").join(of("a"), "a")
    size = {x: F.length(f"items_{x}") / 8 for x in "ab"}
    small, large = F.least(*size.values()), F.greatest(*size.values())
    joined = joined.filter(100 * small >= percent * large)
    shared = F.arrow_udf(_shared, "long")("items_a", "items_b")
    joined = joined.withColumn("_shared", shared)
    union = size["a"] + size["b"] - F.col("_shared")
    return joined.filter(100 * F.col("_shared") >= percent * union).select("a", "b")


def _agree(a: str, b: str) -> Column:
    """On how many coordinates the sketches in columns with these prefixes agree."""
    differ = [F.bit_count(F.col(a + x).bitwiseXOR(F.col(b + x))) for x in _WORDS_OF_SKETCH]
    return F.lit(SKETCHED) - sum(differ[1:], differ[0])


def sketch_agrees(percent: int) -> int:
    """What the sketches of similar enough sets agree on at least. Bits of coordinates
    that differ are equal by chance every other time."""
    expected = percent / 100 + (1 - percent / 100) / 2
    deviation = (expected * (1 - expected) / SKETCHED) ** 0.5
    return int(SKETCHED * (expected - _DEVIATIONS * deviation))


def _labelled(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Adds each class's component so far."""
    labels = stars.select(F.col("node").alias("rep"), "component")
    joined = members.join(labels, "rep", "left")
    return joined.withColumn("component", F.coalesce("component", "rep"))


def _open_buckets(members: DataFrame) -> DataFrame:
    """Buckets that hold several components: their smallest class, the component with the most
    classes, and any one class of that."""
    drawn = F.min_by("rep", F.xxhash64("rep", "key"))
    parts = members.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.min("rep").alias("rep"), drawn.alias("drawn")
    )
    largest = F.max(F.struct("n", "component", "drawn"))
    return (
        parts.groupBy("key")
        .agg(F.count("*").alias("parts"), F.min("rep").alias("first"), largest.alias("largest"))
        .filter(F.col("parts") > 1)
        .select("key", "first", F.col("largest.component").alias("main"), "largest.drawn")
    )


def _with_center(now: DataFrame, opened: DataFrame, stars: DataFrame, center: str) -> DataFrame:
    """Classes paired with the center of their buckets, where they are not connected yet."""
    paired = now.join(opened.select("key", F.col(center).alias("center")).hint("rebalance"), "key")
    paired = paired.filter(F.col("rep") != F.col("center")).select("rep", "component", "center")
    centers = stars.select(F.col("node").alias("center"), F.col("component").alias("of_center"))
    paired = paired.distinct().join(centers, "center", "left")
    apart = paired.filter(F.coalesce("of_center", "center") != F.col("component"))
    return apart.select(
        F.least("center", "rep").alias("a"), F.greatest("center", "rep").alias("b")
    ).distinct()


def _frequencies(sets: DataFrame) -> np.ndarray:
    """In how many sets the shingles of each slot are, at most; a slot is part of a shingle's hash.
    Any order of shingles is right for prefixes, so shingles may share a slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_SLOTS, np.int64)
        for batch in batches:
            for x in values(batch.column("items")):
                np.add.at(counts, _slot(np.frombuffer(x, np.uint64)), 1)
        used = np.flatnonzero(counts)
        columns = [pa.array(used), pa.array(counts[used])]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n"])

    parts = sets.select("items").mapInArrow(lean(run), "slot long, n long")
    counted = parts.groupBy("slot").agg(F.sum("n").alias("n")).filter(F.col("n") > 1)
    found = np.ones(_SLOTS, np.uint32)
    for batch in counted.toArrow().to_batches():  # at most _SLOTS rows
        found[batch.column("slot").to_numpy()] = np.minimum(batch.column("n").to_numpy(), 2**32 - 1)
    return found


def _slot(items: np.ndarray) -> np.ndarray:
    return (_mixed(items) & np.uint64(_SLOTS - 1)).astype(np.int64)


def prefix(items: np.ndarray, frequencies: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, so many that a similar enough set has one of them in its own
    prefix; those that no other set has are left out."""
    n = len(items)
    length = n - -(-percent * n // 100) + 1
    often = frequencies[_slot(items)]
    chosen = np.lexsort((items, often))[:length]
    return items[chosen[often[chosen] > 1]]


def _pairs_by_prefix(hot: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Pairs (a, b) of classes in different components that share a shingle of their prefixes.
    ``hot``: ``rep``, ``component``, ``n_shingles``."""
    own = sets.withColumnRenamed("doc_id", "rep").join(hot, "rep")
    own = scratch.store(own.select("rep", "component", "n_shingles", "items"), "hot-sets")
    sent = hot.sparkSession.sparkContext.broadcast(_frequencies(own))  # _SLOTS numbers
    names = ["rep", "component", "n_shingles", "shingle"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                prefix(np.frombuffer(x, np.uint64), sent.value, percent)
                for x in values(batch.column("items"))
            ]
            repeats = [len(x) for x in found]
            columns = [np.repeat(batch.column(x).to_numpy(), repeats) for x in names[:3]]
            columns.append(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64))
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

    prefixes = own.mapInArrow(lean(run), "rep long, component long, n_shingles long, shingle long")
    prefixes = scratch.store(prefixes, "prefixes")
    x = prefixes.select("shingle", *(F.col(c).alias(f"x_{c}") for c in names[:3]))
    y = prefixes.select("shingle", *(F.col(c).alias(f"y_{c}") for c in names[:3]))
    sizes = [F.col("x_n_shingles"), F.col("y_n_shingles")]
    able = (
        (F.col("x_rep") < F.col("y_rep"))
        & (F.col("x_component") != F.col("y_component"))
        & (100 * F.least(*sizes) >= percent * F.greatest(*sizes))
    )
    found = x.join(y, "shingle").filter(able)
    return found.select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b")).distinct()


def near_duplicates(documents: DataFrame, percent: int = 75, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``: one row per input row.

    Documents are linked if their shingle sets have ``percent`` of their union in common. A
    component's id is its smallest ``doc_id``, which is the one kept. Null texts, empty texts and
    texts without words have an empty set and are linked with nothing. Rows that share a
    ``doc_id`` are one node in links but keep a size each; rows without id are kept, alone, with
    a null component. Other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "minhash")
    sketched = scratch.store(signed(documents, words), "signed")
    usable = sketched.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))

    classes = usable.groupBy("set_high", "set_low").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("rows")
    )
    classes = scratch.store(classes, "classes")
    one = ["set_high", "set_low"]
    reps = usable.join(classes.select("rep", *one), one).filter(F.col("rep") == F.col("doc_id"))
    reps = reps.dropDuplicates(["rep", *one]).select("rep", "bands", "n_shingles")
    reps = scratch.store(reps, "reps")

    bands = reps.select(F.explode("bands").alias("key"), "rep")
    shared = bands.groupBy("key").agg(F.min("rep").alias("first"), F.max("rep").alias("last"))
    shared = shared.filter(F.col("first") < F.col("last")).select("key", "first")
    members = scratch.store(bands.join(shared.hint("rebalance"), "key"), "members")

    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = scratch.store(_sets(documents, ids, words), "sets")

    # 1: the smallest class of all buckets of a class
    pairs = members.filter(F.col("first") < F.col("rep"))
    pairs = pairs.groupBy("rep").agg(F.min("first").alias("a"))
    pairs = pairs.select("a", F.col("rep").alias("b"))
    links = scratch.store(_verified(pairs, sets, percent), "links-1")
    stars = components(links, scratch, "stars-1")

    # 2: the smallest class of each bucket, and any class of its largest component
    now = scratch.store(_labelled(members.select("key", "rep"), stars), "now-2")
    opened = scratch.store(_open_buckets(now), "open-2")
    pairs = [_with_center(now, opened, stars, center) for center in ("first", "drawn")]
    more = _verified(pairs[0].union(pairs[1]).distinct(), sets, percent)
    more = scratch.store(more, "links-2")
    stars = components(stars.union(more), scratch, "stars-2")

    # 3: whoever is not in the largest component of a bucket, with all that are not in its own
    now = _labelled(members.select("key", "rep"), stars)
    now = scratch.store(now.join(reps, "rep"), "now-3")
    open_now = scratch.store(_open_buckets(now).select("key", "main"), "open-3")
    inside = scratch.store(now.join(open_now, "key"), "inside-3")
    sketches = scratch.store(_sketches(sets, inside.select("rep").distinct()), "sketches")
    minors = F.count_if(F.col("component") != F.col("main"))
    crowded = inside.groupBy("key").agg((minors * F.count("*")).alias("pairs"))
    crowded = crowded.filter(F.col("pairs") > HOT_PAIRS).select("key")
    crowded = scratch.store(crowded, "crowded-3")
    hot = inside.join(crowded, "key", "left_semi").select("rep", "component", "n_shingles")
    hot = scratch.store(hot.distinct(), "hot-3")
    inside = inside.join(crowded, "key", "left_anti").join(sketches, "rep")
    fields = ["rep", "component", "n_shingles", "bands", *_WORDS_OF_SKETCH]
    minor = inside.filter(F.col("component") != F.col("main"))
    minor = minor.select("key", *(F.col(x).alias(f"x_{x}") for x in fields))
    other = inside.select("key", *(F.col(x).alias(f"y_{x}") for x in fields))
    sizes = [F.col("x_n_shingles"), F.col("y_n_shingles")]
    # A pair is taken up in the smallest bucket that it shares.
    smallest = F.array_min(F.array_intersect("x_bands", "y_bands"))
    likely = (
        (F.col("x_component") != F.col("y_component"))
        & (100 * F.least(*sizes) >= percent * F.greatest(*sizes))
        & (_agree("x_", "y_") >= sketch_agrees(percent))
        & (F.col("key") == smallest)
    )
    found = minor.join(other.withColumnRenamed("key", "_key"), F.col("key") == F.col("_key"))
    found = found.filter(likely)
    pairs = found.select(F.least("x_rep", "y_rep").alias("a"), F.greatest("x_rep", "y_rep").alias("b"))
    if not hot.isEmpty():
        apart = _pairs_by_prefix(hot, sets, scratch, percent)
        for side in "ab":
            own = [F.col(name).alias(f"{side}_{name}") for name in _WORDS_OF_SKETCH]
            apart = apart.join(sketches.select(F.col("rep").alias(side), *own), side)
        apart = apart.filter(_agree("a_", "b_") >= sketch_agrees(percent))
        pairs = pairs.union(apart.select("a", "b"))
    more = scratch.store(_verified(pairs.distinct(), sets, percent), "links-3")
    stars = components(stars.union(more), scratch, "stars-3")

    final = _labelled(classes.select("rep", *one), stars).select(*one, "component")
    final = scratch.store(final, "final")
    scratch.drop("sets", "reps", "members", "classes", "sketches", "inside-3")
    scratch.drop("now-2", "open-2", "now-3", "open-3", "crowded-3", "hot-3")
    scratch.drop("hot-sets", "prefixes")
    joined = sketched.drop("bands").join(final, one, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
    )
