"""Encoding and decoding whole texts with a merge-type piece model."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pairloom.llm import pieces
from pairloom.llm.common import require_columns


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Whole texts, null as empty; begin and end ids are counted. ``model_path``
    is read on the workers, where the model file must be installed. Only doc_id
    and text are read; no rows give no rows. A row needs nothing but itself, so
    there is no shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() or "" for t in batch.column("text"))
            found = list(pieces.digests(model_path, texts))
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_tokens": pa.array(columns[0], pa.int64()),
                "ids_sha256": pa.array(columns[1], pa.string()), "decoded_sha256": pa.array(columns[2], pa.string()),
            })

    rows = require_columns(docs, ["doc_id", "text"])
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ``ids``, the array of token ids of each whole text (null: begin and end only)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = pieces.encoder(model_path)
        for batch in batches:
            packed = [work.encode(t.as_py() or "") for t in batch.column("text")]
            flat = pa.Array.from_buffers(pa.int32(), sum(map(len, packed)) // 4, [None, pa.py_buffer(b"".join(packed))])
            ends = [0]
            for p in packed:
                ends.append(ends[-1] + len(p) // 4)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": ids})

    rows = require_columns(docs, ["doc_id", "text"])
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and ``text`` of arrays of ids (null as empty); control ids leave no text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = pieces.encoder(model_path)
        for batch in batches:
            texts = [work.decode(pieces.packed_ids(x or [])).decode() for x in batch.column("ids").to_pylist()]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    rows = require_columns(encoded, ["doc_id", "ids"])
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
