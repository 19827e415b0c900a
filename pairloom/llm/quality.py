"""Quality of texts by ordinal cumulative-link regression on graded ratings."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import require_columns

# Labelled rows used for fitting, the ones whose hashes are smallest.
SAMPLE = 6_000
SHAPES, WORDS = 1000, 1024
EXTRA = 3
SIZE = SHAPES + WORDS + EXTRA
# Texts whose features are held at a time.
SLICE = 256


def _classes() -> np.ndarray:
    """Class of each byte: letters, capitals, digits, blank, line end, point, comma, other signs, UTF-8, control."""
    kinds = np.full(256, 7, np.int64)
    kinds[128:], kinds[:32] = 8, 9
    kinds[ord("a"):ord("z") + 1], kinds[ord("A"):ord("Z") + 1], kinds[ord("0"):ord("9") + 1] = 0, 1, 2
    kinds[ord(" ")], kinds[ord("\n")], kinds[ord(".")], kinds[ord(",")] = 3, 4, 5, 6
    return kinds


CLASSES = _classes()


def features(text: str | None) -> np.ndarray:
    """Hashed features of a whole text: shapes of three bytes, words, repetition, length.

    Counts are square-rooted and scaled to length 1 per kind; an empty or null
    text has zeros.
    """
    out = np.zeros(SIZE, np.float32)
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return out
    kinds = CLASSES[np.frombuffer(raw, np.uint8)]
    if len(kinds) >= 3:
        shape = np.sqrt(np.bincount(kinds[:-2] * 100 + kinds[1:-1] * 10 + kinds[2:], minlength=SHAPES))
        out[:SHAPES] = shape / np.linalg.norm(shape)
    words = raw.lower().split()
    if words:
        hashed = np.fromiter(map(crc32, words), np.uint32, len(words))
        bag = np.sqrt(np.bincount(hashed % WORDS, minlength=WORDS))
        out[SHAPES:SHAPES + WORDS] = bag / np.linalg.norm(bag)
        out[-3] = len(np.unique(hashed)) / len(words)
        pairs = hashed[:-1].astype(np.uint64) * np.uint64(0x9E3779B1) + hashed[1:] if len(words) > 1 else hashed
        out[-2] = len(np.unique(pairs)) / len(pairs)
        out[-1] = min(1.0, np.log1p(len(words)) / 10)
    return out


class OrdinalModel:
    """P(grade <= k) = logistic(threshold k - weights . x): one set of weights, ordered thresholds."""

    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def tail(self, x: np.ndarray) -> np.ndarray:
        """P(grade above k) for each row of ``x`` and each but the last grade."""
        z = np.clip((x @ self.weights.astype(x.dtype))[:, None] - self.thresholds[None, :], -30, 30)
        return 1 / (1 + np.exp(-z))

    def rate(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the chance of the best grade."""
        if len(self.grades) < 2:
            only = float(self.grades[0]) if self.grades else 0.0
            return np.full(len(x), only), np.ones(len(x))
        tail = self.tail(x)
        return self.grades[0] + tail @ np.diff(self.grades), tail[:, -1]


def fit_ordinal(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, rounds: int = 150, rate: float = 0.05) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on the whole sample; thresholds stay ordered by their form.

    Each threshold is the one before plus the exponential of a free step.
    Fewer than two grades give a constant model.
    """
    grades = sorted(set(y.tolist()))
    k = len(grades) - 1
    if k < 1:
        return OrdinalModel(grades, np.zeros(x.shape[1]), np.zeros(0))
    place = np.searchsorted(grades, y)
    share = np.clip(np.cumsum(np.bincount(place, minlength=k + 1))[:k] / len(y), 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    free = np.concatenate((np.zeros(x.shape[1]), start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    first, second = np.zeros_like(free), np.zeros_like(free)
    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, rounds + 1):
        weights, cuts = free[:-k], free[-k:].copy()
        cuts[1:] = cuts[0] + np.cumsum(np.exp(free[len(free) - k + 1:]))
        score = (x @ weights.astype(x.dtype)).astype(np.float64)
        padded = np.concatenate(([-np.inf], cuts, [np.inf]))
        high, low = logistic(padded[place + 1] - score), logistic(padded[place] - score)
        high, low = np.where(place == k, 1.0, high), np.where(place == 0, 0.0, low)
        chance = np.maximum(high - low, 1e-9)
        up, down = high * (1 - high) / chance, low * (1 - low) / chance
        slope = np.zeros_like(free)
        slope[:-k] = x.T @ (up - down).astype(x.dtype) / len(y) + ridge * weights
        by_cut = np.array([(down[place == j + 1].sum() - up[place == j].sum()) / len(y) for j in range(k)])
        slope[-k] = by_cut.sum()
        for j in range(1, k):
            slope[len(free) - k + j] = by_cut[j:].sum() * np.exp(free[len(free) - k + j])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        free = free - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    cuts = free[-k:].copy()
    cuts[1:] = cuts[0] + np.cumsum(np.exp(free[len(free) - k + 1:]))
    return OrdinalModel(grades, free[:-k], cuts)


def fit(docs: DataFrame, labels: DataFrame, grade: str = "quality", sample: int = SAMPLE) -> OrdinalModel:
    """A model from at most ``sample`` labelled documents.

    Of a doc_id that is labelled more than once the largest grade counts. The
    sample is the labels with the smallest hashes of doc_id; being bounded, it is
    broadcast to the documents, so no text is shuffled.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(grade).isNotNull()).groupBy("doc_id").agg(
        F.max(grade).cast("int").alias("_grade")
    )
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "_grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [features(t).astype(np.float16).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch({"x": pa.array(packed, pa.binary()), "grade": batch.column("_grade")})

    # A doc_id that several rows share is still bounded: extra rows beyond the sample don't count.
    found = rows.mapInArrow(run, "x binary, grade int").orderBy("x", "grade").limit(sample).toPandas()
    y = found["grade"].to_numpy(np.int64) if len(found) else np.zeros(0, np.int64)
    x = np.zeros((len(found), SIZE), np.float32)
    for i, packed in enumerate(found.pop("x")):
        x[i] = np.frombuffer(packed, np.float16)
    return fit_ordinal(x, y)


def _rated(model: OrdinalModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and chance of the best grade per text, a few feature rows at a time."""
    expected, best = np.zeros(len(texts)), np.zeros(len(texts))
    for start in range(0, len(texts), SLICE):
        x = np.stack([features(t.as_py()) for t in texts.slice(start, SLICE)])
        expected[start:start + SLICE], best[start:start + SLICE] = model.rate(x)
    return expected, best


def rate_documents(docs: DataFrame, labels: DataFrame, grade: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, expected_grade, best_chance, selected (best_chance at least 1/2).

    Empty and null texts are rated by the thresholds alone. Only doc_id and text
    are read; no rows give no rows.
    """
    rows = require_columns(docs, ["doc_id", "text"])
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, grade, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            expected, best = _rated(shared.value, batch.column("text"))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "expected_grade": pa.array(expected), "best_chance": pa.array(best),
            })

    kind = rows.schema["doc_id"].dataType.simpleString()
    rated = rows.mapInArrow(run, f"doc_id {kind}, expected_grade double, best_chance double")
    return rated.withColumn("selected", F.col("best_chance") >= 0.5)


def select(docs: DataFrame, labels: DataFrame, grade: str = "quality", sample: int = SAMPLE, least: float = 0.5) -> DataFrame:
    """``docs`` with all its columns, without those whose chance of the best grade is below ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, grade, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_rated(shared.value, batch.column("text"))[1] >= least))

    return docs.mapInArrow(run, docs.schema)
