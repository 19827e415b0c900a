"""Near-duplicate documents by MinHash bands with sequential Bayesian verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import attach, maybe_in, require_columns, without_rows
from pairloom.llm.near_links import linked_components
from pairloom.llm.shingles import MinHash, shingle_set, word_marks, words_of
from pairloom.session import Workspace

# A link at similarity 0.75 misses every band once in 190,000 times.
BANDS, ROWS = 32, 4
PER_CENT = 75
# Chance at which the signatures may give a linked pair up.
MISS = 1e-6


def _sketches(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal for equal sets, null for empty ones), buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinHash(bands, rows)
        for batch in batches:
            sets = [shingle_set(word_marks(words_of(raw.as_py()))) for raw in batch.column("text").cast(pa.binary())]
            keys = [xxhash.xxh3_128_digest(s.astype("<u8").tobytes()) if len(s) else None for s in sets]
            buckets = [hashing.buckets(hashing.signatures(s, _ONE))[0] if len(s) else None for s in sets]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "set_key": pa.array(keys, pa.binary()), "buckets": pa.array(buckets, pa.list_(pa.int64())),
            })

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, buckets array<long>")


_ONE = np.zeros(1, np.int64)


def _details(docs: DataFrame, ids: DataFrame, bands: int, rows: int) -> DataFrame:
    """id, signature and full shingle set of the documents in ``ids``, from their whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinHash(bands, rows)
        for batch in batches:
            sets = [shingle_set(word_marks(words_of(raw.as_py()))) for raw in batch.column("text").cast(pa.binary())]
            yield pa.record_batch({
                "id": batch.column("id").filter(pa.array([len(s) > 0 for s in sets], pa.bool_())),
                "signature": pa.array([hashing.signatures(s, _ONE).astype("<u4").tobytes() for s in sets if len(s)], pa.binary()),
                "set": pa.array([s.astype("<u8").tobytes() for s in sets if len(s)], pa.binary()),
            })

    named = docs.select(F.col("doc_id").alias("id"), "text")
    wanted = maybe_in(named, "id", ids, "_maybe").where("_maybe").select("id", "text")
    return wanted.mapInArrow(run, "id long, signature binary, set binary")


def near_groups(
    docs: DataFrame, tables: Workspace | None = None, bands: int = BANDS, rows: int = ROWS, per_cent: int = PER_CENT,
    miss: float = MISS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of five-word shingles (A-Z lower-cased,
    whole texts) have 100 * intersection >= per_cent * union; ``component_id`` is
    the smallest doc_id reachable over links, and only that document is kept.
    Fewer than five words are one shingle; null and blank texts have no shingle
    and no link. doc_id must identify a row; a row without one is linked only to
    equal sets and not kept. Only doc_id and text are read.

    Equal sets are folded first, so thousands of copies cost one comparison each.
    Sets are of 64-bit fingerprints of shingles.
    """
    docs = require_columns(docs, ["doc_id", "text"])
    tables = tables or Workspace(docs.sparkSession, "near")
    known = tables.save(_sketches(docs, bands, rows))
    total = max(1, known.count())
    folds = known.where(F.col("set_key").isNotNull()).groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")
    )
    folds = tables.save(folds.where((F.col("n") > 1) & F.col("rep").isNotNull()))
    own = tables.save(
        attach(known.select("doc_id", "n_shingles", "set_key"), folds, "set_key", "n", total)
        .select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"), F.coalesce("n", F.lit(1)).alias("n"))
    )
    apart = without_rows(
        known.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()), own.where(F.col("rep") != F.col("doc_id"))
    )
    items = apart.select(F.col("doc_id").alias("id"), "buckets")
    details = lambda ids: _details(docs, ids, bands, rows)
    found = tables.save(linked_components(items, details, bands, rows, per_cent, miss, tables))
    sizes = own.groupBy("rep").agg(F.max("n").alias("_n"))
    groups = tables.save(found.select(F.col("node").alias("rep"), "component").join(sizes, "rep"))
    tables.drop(known)
    named = attach(own, groups, "rep", "_n", total)
    component = F.coalesce("component", "rep")
    return named.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame, tables: Workspace | None = None) -> DataFrame:
    """``docs`` with all its columns and one row of each group: the one with the smallest doc_id.

    Where rows share that doc_id, or none of a group has one, one of them stays.
    Texts without shingles are in no group and all stay, as do rows that share a
    doc_id with a copy but not its text. If doc_ids repeat or are missing, the rows
    are numbered in a saved table first.
    """
    tables = tables or Workspace(docs.sparkSession, "near")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where((F.col("n") > 1) | F.col("doc_id").isNull()).isEmpty():
        return without_rows(docs, near_groups(docs, tables).where(~F.col("kept")))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = tables.save(docs.select(row.alias("_row"), F.monotonically_increasing_id().alias("_at")))
    named = rows.select(F.col("_at").alias("doc_id"), F.col("_row.text").alias("text"))
    found = tables.save(near_groups(named, tables).select(F.col("doc_id").alias("_at"), "component_id"))
    groups = found.where(F.col("_at") != F.col("component_id")).select("component_id").distinct()
    members = found.join(groups.hint("merge"), "component_id", "left_semi")
    members = tables.save(members.join(rows.select("_at", F.col("_row.doc_id").alias("doc_id")).hint("merge"), "_at"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_at")
    stays = members.groupBy("component_id").agg(F.min(order).alias("_first")).select(F.col("_first._at").alias("_at"))
    dropped = members.join(stays.hint("merge"), "_at", "left_anti")
    return without_rows(rows, dropped, "_at").select("_row.*")
