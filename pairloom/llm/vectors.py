"""Embeddings as bytes, and exact inner products of vectors of whole numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import require_columns

# Sums of whole numbers stay exact in doubles below this.
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def packed(vectors: DataFrame, names: Sequence[str], shape: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """The columns ``names`` beside ``dim``, ``largest`` and ``vec``.

    ``vec`` is the embedding as little-endian doubles, ``largest`` its greatest
    magnitude (0 without components). ``shape`` maps all components at once. All
    three are null if the embedding is, or if a component is null or not finite,
    before or after ``shape``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype("<f8")
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            # Components out of a double's range become infinite.
            with np.errstate(over="ignore", invalid="ignore"):
                flat = flat if shape is None else shape(flat)
            ends = np.cumsum(sizes)
            wrong = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
            fine = (wrong[ends] == wrong[ends - sizes]) & pc.is_valid(lists).to_numpy(zero_copy_only=False)
            padded = np.append(np.abs(flat), 0.0)
            largest = np.where(sizes > 0, np.maximum.reduceat(padded, ends - sizes) if len(sizes) else 0.0, 0.0)
            spans = zip((ends - sizes).tolist(), ends.tolist(), fine.tolist(), strict=True)
            yield pa.record_batch({
                **{n: batch.column(n) for n in names}, "dim": pa.array(sizes, pa.int32(), mask=~fine),
                "largest": pa.array(largest, pa.float64(), mask=~fine),
                "vec": pa.array([flat[a:b].tobytes() if ok else None for a, b, ok in spans], pa.binary()),
            })

    rows = require_columns(vectors, [*names, "embedding"])
    types = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(run, f"{types}, dim int, largest double, vec binary")


def whole_numbers(scale: float) -> Callable[[np.ndarray], np.ndarray]:
    """x to floor(scale * x), a double that holds a whole number."""
    return lambda x: np.floor(scale * x)


def matrix(column: Sequence[bytes], kind: str = "<f8") -> np.ndarray:
    """One row per entry of ``column``, all of equal length."""
    return np.frombuffer(b"".join(column), kind).reshape(len(column), -1)


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of two matrices of whole numbers, exactly, as 64-bit integers.

    Products beyond 64 bits count as the nearest end of their range.
    """
    out = np.zeros((len(left), len(right)), np.int64)
    if not out.size:
        return out
    width = max(1, left.shape[1])
    largest = lambda x: np.abs(x).max(axis=1, initial=0)
    most = largest(right).max()
    with np.errstate(over="ignore"):
        small = largest(left) * most * width < EXACT
    out[small] = (left[small] @ right.T).astype(np.int64)
    if not small.all():
        other = np.array([[int(x) for x in row] for row in right.tolist()], dtype=object).reshape(right.shape)
        for i in np.flatnonzero(~small).tolist():
            own = np.array([int(x) for x in left[i].tolist()], dtype=object)
            out[i] = [min(max(int(x), LEAST), MOST) for x in other.dot(own)]
    return out


def blocks(n: Column, size: int) -> Column:
    """How many blocks of ``size`` rows hold ``n`` rows."""
    return F.greatest(F.lit(1), F.ceil(n / size)).cast("int")


def every(n: Column) -> Column:
    """One row per number from 0 to ``n`` - 1."""
    return F.explode(F.sequence(F.lit(0), n - 1))
