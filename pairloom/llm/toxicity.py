"""Toxicity by maximum-scoring segments, learnt from labelled documents."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import maybe_in, require_columns
from pairloom.llm.segments import (
    LEVELS, SLOTS, Remember, SegmentModel, fit_logistic, gumbel_rate, log_odds, segments, slots, words_of,
)
from pairloom.session import Workspace

FOLDS = 5
# Weight of the Dirichlet prior against the labelled documents.
PRIOR_SHARE = 0.002
# Log-odds count for what they are sure of by this many deviations.
CERTAIN = 2.0
# Every word costs this much, so that segments of indifferent words sum below 0.
DRIFT = 1.0
# Histograms of word scores and of evidence: one size for any corpus.
BINS = 4000
SCORE_LOW, SCORE_HIGH = -20.0, 20.0
LOW, HIGH = -100.0, 300.0
GAMMA = 0.5772156649015329


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled(docs: DataFrame, labels: DataFrame, target: str) -> DataFrame:
    """text and label of the documents whose label is 0 or 1; other texts aren't shuffled.

    Rows of ``labels`` that repeat a doc_id count once, with the largest label.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1))
    known = known.groupBy("doc_id").agg(F.max(target).cast("int").alias("label"))
    near = maybe_in(docs.select("doc_id", "text"), "doc_id", known, "_maybe").where("_maybe").drop("_maybe")
    return near.join(known, "doc_id").select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", tables: Workspace | None = None) -> SegmentModel:
    """A model from all labelled documents; only their text and label are read.

    Token counts are summed per slot of a fixed table, in tasks first, so what
    reaches the driver has one size for any corpus. The constants of the
    extreme-value law follow from the plain documents: the rate from the token
    scores, the scale from the mean best segment. Without documents of both
    labels every score is the share of the label.
    """
    tables = tables or Workspace(docs.sparkSession, "toxic")
    known = tables.save(labelled(docs, labels, target))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, known_slots = np.zeros((2, LEVELS * SLOTS)), Remember(slots)
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                # A word says no more for being repeated in one text.
                found = {s for word in set(words_of(text)) for s in known_slots[word]}
                sums[label][list(found)] += 1.0
        some = np.flatnonzero(sums.sum(0))
        yield pa.record_batch({
            "slot": pa.array(some, pa.int32()), "plain": pa.array(sums[0][some]), "marked": pa.array(sums[1][some])
        })

    rows = (
        known.mapInArrow(count, "slot int, plain double, marked double")
        .groupBy("slot").agg(F.sum("plain").alias("plain"), F.sum("marked").alias("marked")).toPandas()
    )
    plain, marked = np.zeros(LEVELS * SLOTS), np.zeros(LEVELS * SLOTS)
    plain[rows["slot"]], marked[rows["slot"]] = rows["plain"], rows["marked"]
    if not plain.sum() or not marked.sum():
        offset = 30.0 if marked.sum() else -30.0
        return SegmentModel(np.zeros(LEVELS * SLOTS), DRIFT, slope=0.0, offset=offset)
    scores = np.concatenate([
        log_odds(m, p, PRIOR_SHARE, CERTAIN) for m, p in zip(np.split(marked, LEVELS), np.split(plain, LEVELS), strict=True)
    ])
    raw = SegmentModel(scores, DRIFT)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BINS)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                place = (raw.word_scores(text) - SCORE_LOW) * (BINS / (SCORE_HIGH - SCORE_LOW))
                n += np.bincount(np.clip(place, 0, BINS - 1).astype(np.int64), minlength=BINS)
        some = np.flatnonzero(n)
        yield pa.record_batch({"bin": pa.array(some, pa.int32()), "n": pa.array(n[some])})

    words = known.where("label = 0").mapInArrow(spread, "bin int, n double").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()
    middle = SCORE_LOW + (words["bin"].to_numpy() + 0.5) * (SCORE_HIGH - SCORE_LOW) / BINS
    rate = gumbel_rate(middle, words["n"].to_numpy())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [raw.word_scores(t) for t in batch.column("text").to_pylist()]
            sums = [[s for _, _, s in segments(x)] for x in found]
            yield pa.record_batch({
                "label": batch.column("label"), "n": pa.array([len(x) for x in found], pa.int64()),
                "sums": pa.array(sums, pa.list_(pa.float64())),
            })

    seen = tables.save(known.mapInArrow(measure, "label int, n long, sums array<double>"))
    # A best sum M over n words has the mean (log(K n) + gamma) / rate.
    best = F.coalesce(F.array_max("sums"), F.lit(0.0)) * rate - F.log(F.greatest(F.lit(1.0), F.col("n").cast("double")))
    log_k = (seen.where("label = 0").agg(F.avg(best)).first()[0] or 0.0) - GAMMA
    sized = SegmentModel(scores[:1], DRIFT, rate, log_k)

    def calibrate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BINS))
        for batch in batches:
            for label, words, sums in zip(*(batch.column(c).to_pylist() for c in ("label", "n", "sums")), strict=True):
                place = (sized.overall(sums, words) - LOW) * (BINS / (HIGH - LOW))
                n[label, min(BINS - 1, max(0, int(place)))] += 1
        some = np.flatnonzero(n.sum(0))
        yield pa.record_batch({"bin": pa.array(some, pa.int32()), "zeros": pa.array(n[0][some]), "ones": pa.array(n[1][some])})

    bins = seen.mapInArrow(calibrate, "bin int, zeros double, ones double").groupBy("bin").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")
    ).toPandas()
    slope, offset = fit_logistic(LOW + (bins["bin"] + 0.5) * (HIGH - LOW) / BINS, bins["ones"], bins["zeros"])
    tables.drop(known, seen)
    return SegmentModel(scores, DRIFT, rate, log_k, slope, offset)


def score(docs: DataFrame, model: SegmentModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted, n_passages, best_first, best_last.

    ``score`` (0 to 1) is the calibrated chance of the label, from the text's
    segments beyond chance; empty and null texts have one too. ``n_passages`` counts the segments
    expected less than once in 100 plain texts; ``best_first`` and ``best_last``
    number the words of the best segment from 0 (null: none).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = shared.value
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column("text").to_pylist():
                evidence, each = work.passages(text)
                best = max(each, key=lambda s: s[3], default=(None, None, 0, 0))
                out.append((work.chance(evidence), sum(e >= math.log(100) for *_, e in each), best[0], best[1]))
            chance, n, first, last = list(zip(*out, strict=True)) or ((), (), (), ())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "score": pa.array(chance, pa.float64()),
                "predicted": pa.array([int(c >= 0.5) for c in chance], pa.int32()), "n_passages": pa.array(n, pa.int32()),
                "best_first": pa.array(first, pa.int32()), "best_last": pa.array(last, pa.int32()),
            })

    rows = require_columns(docs, ["doc_id", "text"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, n_passages int, best_first int, best_last int"
    )


def passages(docs: DataFrame, model: SegmentModel, expected: float = 0.01) -> DataFrame:
    """Every passage expected less than ``expected`` times by chance: doc_id, first and last word, score, log_expected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc, a, b, s, -e)
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                for a, b, s, e in shared.value.passages(text)[1] if e >= -math.log(expected)
            ]
            columns = list(zip(*rows, strict=True)) or [(), (), (), (), ()]
            yield pa.record_batch({
                "doc_id": pa.array(columns[0], batch.schema.field("doc_id").type), "first_word": pa.array(columns[1], pa.int32()),
                "last_word": pa.array(columns[2], pa.int32()), "score": pa.array(columns[3], pa.float64()),
                "log_expected": pa.array(columns[4], pa.float64()),
            })

    rows = require_columns(docs, ["doc_id", "text"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, first_word int, last_word int, score double, log_expected double")


def score_held_out(docs: DataFrame, labels: DataFrame, target: str = "toxic", tables: Workspace | None = None) -> DataFrame:
    """``score`` of all ``docs`` by a model that never sees labels of the held-out fifth, and ``held_out``."""
    train = labels.where(fold(F.col("doc_id")) != 0)
    model = fit(docs, train, target, tables)
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return score(docs, model).withColumn("held_out", held)
