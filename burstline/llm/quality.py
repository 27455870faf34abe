"""Quality classifier: naive Bayes support vectors.

Features are indicators of n-grams, hashed to a fixed number of buckets: words, pairs of words
and runs of three bytes. Each indicator is scaled by its log-count ratio between the classes, a
text's vector is brought to unit length, and a linear model with hinge loss is fitted by dual
coordinate descent. A logistic curve over margins of rows that the fit has not seen turns margins
into scores.

The fit uses a bounded sample of labelled rows (``SAMPLE_ROWS``), drawn by a hash of the id and
broadcast, so documents are never shuffled. The model is as large as the buckets, whatever the
corpus. Scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.storage import Scratch, lean, release_unused, values

SAMPLE_ROWS = 8000
BUCKET_BITS = 18
KEEP_FROM = 0.3
PENALTY = 1.0
EPOCHS = 15
SMOOTHING = 1.0
CALIBRATION_SHARE = 4  # one row in so many is kept from the fit for the scores
_PRIME = np.uint32(0x01000193)
_SLICE = 1 << 20


def _scattered(x: np.ndarray, seed: int) -> np.ndarray:
    x = x * np.uint32(0x9E3779B1) + np.uint32(seed)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return (x ^ (x >> np.uint32(13))) >> np.uint32(32 - BUCKET_BITS)


def _word_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each run of bytes above the space."""
    inside = data > 32
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    if not len(starts):
        return np.zeros(0, np.uint32)
    ends = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    lengths = ends - starts
    power = np.cumprod(np.full(int(lengths.max()), _PRIME, np.uint32), dtype=np.uint32)
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    value = (data[inside].astype(np.uint32) + np.uint32(1)) * power[at]
    return np.add.reduceat(value, first, dtype=np.uint32)


class Indicators:
    """Distinct buckets of a text, found with one scratch array instead of sorting."""

    def __init__(self):
        self.last = np.zeros(1 << BUCKET_BITS, np.int64)

    def of(self, text: bytes) -> np.ndarray:
        """Read in slices; a word that a slice cuts is put together, and the last whole word is
        paired with the first of the next slice, so the buckets are those of the uncut text."""
        parts, data = [], np.frombuffer(text, np.uint8)
        before = np.zeros(0, np.uint32)  # the last whole word
        begun, length = 0, 0  # hash and bytes of a word that the slice before has cut
        for first in range(0, len(data), _SLICE):
            end = min(first + _SLICE, len(data))
            part = data[first:end]
            words = _word_hashes(part)
            gaps = np.flatnonzero(part <= 32)
            if length and part[0] > 32:
                power = pow(int(_PRIME), length, 1 << 32)
                words[0] = (begun + power * int(words[0])) & 0xFFFFFFFF
            elif length:
                words = np.concatenate([np.array([begun], np.uint32), words])
            if end < len(data) and part[-1] > 32:
                begun, words = int(words[-1]), words[:-1]
                length = end - first - 1 - int(gaps[-1]) if len(gaps) else length + end - first
            else:
                length = 0
            linked = np.concatenate([before, words])
            before = linked[-1:]
            parts.append(self._distinct(self._buckets(words, linked, data[max(0, first - 2) : end])))
        if len(parts) <= 1:
            return parts[0] if parts else np.zeros(0, np.int32)
        return self._distinct(np.concatenate(parts))

    def _buckets(self, words: np.ndarray, linked: np.ndarray, data: np.ndarray) -> np.ndarray:
        wide = data.astype(np.uint32)
        runs = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
        pairs = linked[:-1] * np.uint32(31) + linked[1:]
        return np.concatenate(
            [_scattered(words, 1), _scattered(pairs, 2), _scattered(runs, 3)]
        ).astype(np.int32)

    def _distinct(self, buckets: np.ndarray) -> np.ndarray:
        order = np.arange(len(buckets))
        self.last[buckets] = order
        return buckets[self.last[buckets] == order]


@dataclass
class Model:
    """Weight of each bucket on the unit-length vector, and the curve from margin to score."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, buckets: np.ndarray) -> float:
        scale = self.ratios[buckets]
        norm = float(np.sqrt(scale @ scale))
        return (float(self.weights[buckets] @ scale) / norm if norm else 0.0) + self.bias

    def score(self, buckets: np.ndarray) -> float:
        x = self.slope * self.margin(buckets) + self.shift
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def _log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    counts = np.full((2, 1 << BUCKET_BITS), SMOOTHING)
    for row, label in zip(rows, labels):
        counts[label][row] += 1
    counts /= counts.sum(1, keepdims=True)
    return np.log(counts[1] / counts[0])


def _dual_coordinate_descent(
    rows: list[np.ndarray], scales: list[np.ndarray], signs: np.ndarray
) -> tuple[np.ndarray, float]:
    """Hinge loss, L2 penalty: one dual variable at a time, within 0 and the penalty."""
    weights, bias = np.zeros(1 << BUCKET_BITS), 0.0
    alpha = np.zeros(len(rows))
    squared = np.array([x @ x for x in scales]) + 1.0  # 1 for the bias
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        moved = 0.0
        for k in rng.permutation(len(rows)):
            row, x, y = rows[k], scales[k], signs[k]
            gradient = y * (float(weights[row] @ x) + bias) - 1
            new = min(max(alpha[k] - gradient / squared[k], 0.0), PENALTY)
            step = (new - alpha[k]) * y
            if step:
                alpha[k] = new
                weights[row] += step * x
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights, bias


def _logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with targets drawn in from 0 and 1 a little."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 1e-6)), float(beta[1])


def fitted(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model of rows in a fixed order. With one class or none its score is constant: the
    share of label 1, one row of each class added."""
    labels = labels.astype(np.int64)
    zero = np.zeros(1 << BUCKET_BITS)
    kept_back = np.arange(len(rows)) % CALIBRATION_SHARE == 0
    fit = np.flatnonzero(~kept_back)
    if len(np.unique(labels[fit])) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(zero, zero, 0.0, 1.0, float(np.log(share / (1 - share))))
    own = [rows[k] for k in fit]
    ratios = _log_count_ratios(own, labels[fit])
    scales = [ratios[row] for row in own]
    scales = [x / max(np.sqrt(x @ x), 1e-12) for x in scales]
    weights, bias = _dual_coordinate_descent(own, scales, labels[fit] * 2 - 1)
    model = Model(ratios, weights, bias, 1.0, 0.0)
    margins = np.array([model.margin(rows[k]) for k in np.flatnonzero(kept_back)])
    model.slope, model.shift = _logistic_curve(margins, labels[kept_back])
    return model


def _sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, the same for the same labels. Labels other than 0 and 1
    are left out; an id labelled both ways counts as 0."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    known = known.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = known.count()
    share = min(1.0, 0.95 * rows / max(total, 1))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(round(share * 1_000_000))
    return known.filter(drawn).limit(rows)


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learns from the labelled documents. Null texts are empty."""
    scratch = Scratch(documents.sparkSession, "quality")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            rows = [indicators.of(x or b"").tobytes() for x in values(batch.column("text"))]
            columns = [batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "quality", "buckets"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [x for batch in batches for x in zip(*(values(c) for c in batch.columns))]
        seen.sort()
        rows = [np.frombuffer(x[2], np.int32) for x in seen]
        model = fitted(rows, np.array([x[1] for x in seen], np.int64))
        arrays = [model.ratios.tobytes(), model.weights.tobytes()]
        numbers = [model.bias, model.slope, model.shift]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([x], pa.binary()) for x in arrays), *(pa.array([x]) for x in numbers)],
            ["ratios", "weights", "bias", "slope", "shift"],
        )

    # The sample has at most sample_rows rows of two numbers.
    chosen = F.broadcast(scratch.store(_sample(labels, sample_rows), "sample"))
    texts = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text")
    )
    labelled = texts.join(chosen, "doc_id").select("doc_id", "quality", "text")
    rows = scratch.store(
        labelled.mapInArrow(lean(features), "doc_id long, quality int, buckets binary"), "rows"
    )
    schema = "ratios binary, weights binary, bias double, slope double, shift double"
    found = rows.repartition(1).mapInArrow(lean(train), schema).collect()
    scratch.drop("sample", "rows")
    if not found:
        return fitted([], np.zeros(0))
    ratios, weights = (np.frombuffer(found[0][k], np.float64) for k in ("ratios", "weights"))
    return Model(ratios, weights, found[0].bias, found[0].slope, found[0].shift)


def with_score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds a score, 0 to 1, higher where label 1 is likelier. Null and empty texts have the
    score of a text without n-grams. Other columns stay; one called ``name`` is replaced."""
    sent = documents.sparkSession.sparkContext.broadcast(model)  # 4 MB at 18 bits

    def score(texts: pa.Array) -> pa.Array:
        indicators, model = Indicators(), sent.value
        scores = [model.score(indicators.of(x or b"")) for x in values(texts)]
        release_unused()
        return pa.array(scores, pa.float64())

    text = F.col("text").cast("string").cast("binary")
    return documents.withColumn(name, F.arrow_udf(score, "double")(text))


def held_out(doc_id="doc_id"):
    """Rows that no label is learned from: crc32 of the id as text leaves 0 by 5."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
