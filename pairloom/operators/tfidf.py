"""TF-IDF as relational algebra: term counts, a capped vocabulary, unit vectors.

Weights follow the usual smoothed form: ``idf = ln((1 + n) / (1 + df)) + 1``,
weight ``tf * idf`` (or ``(1 + ln tf) * idf``), then L2 norm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def term_counts(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """(key, term, tf). The texts are shuffled once by key; counting needs no further shuffle.

    The number of partitions is given, since a text grows many times over when
    its terms are listed and partitions sized by the text would be too large.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    exploded = docs.repartition(parts, F.col(key)).select(key, F.explode(terms).alias("term"))
    return exploded.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def row_counts(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """`term_counts` of short texts under a unique ``key``: a row counts its own terms, so nothing is shuffled.

    Each term is compared with all of its text, which suits titles and not documents.
    """
    listed = docs.select(key, terms.alias("_terms"))
    count = F.transform(F.array_distinct("_terms"), lambda t: F.struct(
        t.alias("term"), F.size(F.filter("_terms", lambda o: o == t)).cast("long").alias("tf")
    ))
    return listed.select(key, F.explode(count).alias("_count")).select(key, "_count.term", "_count.tf")


def vocabulary(counts: DataFrame, docs: DataFrame, max_features: int) -> DataFrame:
    """(term, term_id, idf) of the ``max_features`` most frequent terms, ties alphabetical.

    Frequencies are combined map-side before the shuffle. The result has at
    most ``max_features`` rows, which is what bounds the numbering window and
    every broadcast of it.
    """
    return _most_frequent(counts.groupBy("term").agg(F.sum("tf").alias("corpus_tf"), F.count(F.lit(1)).alias("df")), docs, max_features)


def _most_frequent(totals: DataFrame, docs: DataFrame, max_features: int) -> DataFrame:
    """`vocabulary` of (term, corpus_tf, df)."""
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    kept = totals.orderBy(F.col("corpus_tf").desc(), "term").limit(max_features)
    return kept.select(
        "term",
        F.row_number().over(Window.orderBy("term")).alias("term_id"),
        (F.log((n_docs + 1) / (F.col("df") + 1)) + 1).alias("idf"),
    )


def term_lists(docs: DataFrame, key: str, terms: Column) -> DataFrame:
    """(key, terms, tfs): the different terms of each row as an array, and how often each comes; rows without terms are left out.

    Texts aren't shuffled, so rows of a repeated key stay apart; see ``merged_lists``.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, term = _flat(batch.column("_terms"))
            coded = term.dictionary_encode()
            size = max(1, len(coded.dictionary))
            # One number per row and term; rows come in their order.
            pairs, tfs = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
            rows, starts = np.unique(pairs // size, return_index=True)
            ends = pa.array(np.append(starts, len(pairs)), pa.int32())
            yield pa.record_batch({
                key: batch.column(key).take(pa.array(rows, pa.int64())),
                "terms": pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(pairs % size, pa.int64()))),
                "tfs": pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32())),
            })

    return docs.select(key, terms.alias("_terms")).mapInArrow(run, f"`{key}` {kind}, terms array<string>, tfs array<int>")


def merged_lists(lists: DataFrame, key: str) -> DataFrame:
    """``lists`` of `term_lists` with one row per key; as they are if no key is repeated."""
    if lists.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        return lists
    each = lists.select(key, F.explode(F.arrays_zip("terms", "tfs")).alias("_t")).select(key, "_t.terms", "_t.tfs")
    each = each.groupBy(key, "terms").agg(F.sum("tfs").cast("int").alias("tfs"))
    both = each.groupBy(key).agg(F.collect_list(F.struct("terms", "tfs")).alias("_t"))
    return both.select(key, F.col("_t.terms").alias("terms"), F.col("_t.tfs").alias("tfs"))


def list_vocabulary(lists: DataFrame, docs: DataFrame, max_features: int) -> DataFrame:
    """`vocabulary` of `term_lists`: batches are totalled inside tasks, so terms are shuffled once per batch and not per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = _flat(batch.column("terms"))[1].dictionary_encode()
            codes, n = coded.indices.to_numpy(), len(coded.dictionary)
            tf = np.bincount(codes, weights=_flat(batch.column("tfs"))[1].to_numpy(), minlength=n).astype(np.int64)
            yield pa.record_batch({"term": coded.dictionary, "tf": pa.array(tf), "df": pa.array(np.bincount(codes, minlength=n), pa.int64())})

    totals = lists.select("terms", "tfs").mapInArrow(run, "term string, tf long, df long")
    return _most_frequent(totals.groupBy("term").agg(F.sum("tf").alias("corpus_tf"), F.sum("df").alias("df")), docs, max_features)


def list_vectors(lists: DataFrame, vocab: DataFrame, key: str, sublinear: bool = False) -> DataFrame:
    """`unit_vectors` of lists with one row per key; nothing is shuffled. ``vocab`` is broadcast."""
    known = vocab.orderBy("term_id").toPandas()
    kind = lists.schema[key].dataType.simpleString()
    shared = lists.sparkSession.sparkContext.broadcast((known["term"].tolist(), known["term_id"].to_numpy(), known["idf"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, term_ids, idf = shared.value
        terms = pa.array(terms, pa.string())
        for batch in batches:
            row, term = _flat(batch.column("terms"))
            at = pc.index_in(term.cast(pa.string()), value_set=terms)
            found = pc.is_valid(at).to_numpy(zero_copy_only=False)
            row, at = row[found], at.drop_null().to_numpy()
            tf = _flat(batch.column("tfs"))[1].to_numpy()[found]
            order = np.argsort(row * max(1, len(terms)) + at)
            row, at, tf = row[order], at[order], tf[order]
            weights = (np.log(tf) + 1 if sublinear else tf) * idf[at]
            rows, starts = np.unique(row, return_index=True)
            sizes = np.diff(np.append(starts, len(row)))
            norms = np.sqrt(np.add.reduceat(weights * weights, starts)) if len(rows) else np.zeros(0)
            ends = pa.array(np.append(starts, len(row)), pa.int32())
            yield pa.record_batch({
                key: batch.column(key).take(pa.array(rows, pa.int64())),
                "ids": pa.ListArray.from_arrays(ends, pa.array(term_ids[at], pa.int32())),
                "weights": pa.ListArray.from_arrays(ends, pa.array(weights / np.repeat(norms, sizes), pa.float64())),
            })

    return lists.mapInArrow(run, f"`{key}` {kind}, ids array<int>, weights array<double>")


def _flat(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row numbers and values of all elements."""
    return pc.list_parent_indices(lists).to_numpy().astype(np.int64), pc.list_flatten(lists)


def unit_vectors(counts: DataFrame, vocab: DataFrame, key: str, sublinear: bool = False) -> DataFrame:
    """(key, ids, weights): term ids ascending and weights of unit length.

    ``vocab`` is broadcast: it holds at most ``max_features`` rows. Documents
    without a known term have no row.
    """
    tf = F.log(F.col("tf")) + 1 if sublinear else F.col("tf")
    weighted = counts.join(F.broadcast(vocab), "term").select(key, "term_id", (tf * F.col("idf")).alias("w"))
    grouped = weighted.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("term_id", "w"))).alias("v"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"),
    )
    return grouped.select(
        key,
        F.col("v.term_id").alias("ids"),
        F.transform("v.w", lambda w: w / F.col("norm")).alias("weights"),
    )


def fit_transform(
    docs: DataFrame, key: str, terms: Column, max_features: int, sublinear: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Vocabulary and unit vectors of ``docs``, whose ``key`` is unique."""
    counts = term_counts(docs, key, terms)
    vocab = vocabulary(counts, docs, max_features)
    return vocab, unit_vectors(counts, vocab, key, sublinear)


def sparse_dot(left_ids: Column, left_weights: Column, right_ids: Column, right_weights: Column) -> Column:
    """Dot product of two sparse vectors; 0 when they share no term or one is null."""
    def at(ids: Column, weights: Column, term: Column) -> Column:
        return F.element_at(weights, F.array_position(ids, term).cast("int"))

    shared = F.array_intersect(left_ids, right_ids)
    total = F.aggregate(
        shared, F.lit(0.0),
        lambda acc, t: acc + at(left_ids, left_weights, t) * at(right_ids, right_weights, t),
    )
    return F.coalesce(total, F.lit(0.0))
