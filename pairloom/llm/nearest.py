"""Exact top-k inner products by vector-approximation files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from pairloom.llm.common import require_columns
from pairloom.llm.vectors import LEAST, MOST, matrix, products
from pairloom.session import Workspace

CELLS = 64
# Vectors whose components set the cell borders; any borders give right results.
BORDER_SAMPLE = 1000
VECTORS_PER_BLOCK, QUERIES_PER_BLOCK = 8192, 2048
# Vectors read per query and wanted result before the first exact bound is known.
FIRST_READS = 4
# Doubles from here on are whole numbers already.
WHOLE = float(1 << 52)
# Sums of doubles are off by far less than this share of what they add up.
ROUNDING = 1e-12


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and ``v``, each component x as floor(scale * x), a double that holds a whole number.

    Null vectors and ids, and vectors with a component that is null or not finite
    (before or after scaling) are left out. Equal rows count once.
    """
    scaled = lambda x: x.cast("double") * scale
    cell = lambda x: F.when(F.abs(scaled(x)) < WHOLE, F.floor(scaled(x)).cast("double")).otherwise(scaled(x))
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(scaled(x)) < float("inf")))
    rows = require_columns(vectors, ["vec_id", "embedding"]).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return rows.where(F.coalesce(fits, F.lit(False))).select(
        "vec_id", F.transform("embedding", cell).alias("v")
    ).dropDuplicates(["vec_id", "v"])


def _packed(rows: DataFrame, borders: np.ndarray) -> DataFrame:
    """vec_id, dim, vec (doubles as bytes), code (the cell of each component as bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8")
            sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            ends = np.cumsum(sizes)
            codes = np.searchsorted(borders, flat, side="right").astype(np.uint8)
            spans = list(zip((ends - sizes).tolist(), ends.tolist(), strict=True))
            yield pa.record_batch({
                "vec_id": batch.column("vec_id"), "dim": pa.array(sizes, pa.int32()),
                "vec": pa.array([flat[a:b].tobytes() for a, b in spans], pa.binary()),
                "code": pa.array([codes[a:b].tobytes() for a, b in spans], pa.binary()),
            })

    return rows.mapInArrow(run, "vec_id long, dim int, vec binary, code binary")


@pandas_udf(LongType())
def inner_product(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(
        [int(products(matrix([a]), matrix([b]))[0, 0]) if a else 0 for a, b in zip(left, right, strict=True)], dtype="int64"
    )


def _borders(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inner cell borders from a bounded sample, and centre and half width of each cell, ends included."""
    ends = rows.agg(F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    low, high = (ends[0] or 0), (ends[1] or 0)
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(BORDER_SAMPLE).select("v").collect()
    values = np.array([x for r in some for x in r[0]] or [0])
    inner = np.unique(np.quantile(values, np.linspace(0, 1, CELLS + 1)[1:-1]).round())
    inner = inner[(inner > low) & (inner <= high)]
    # Cell c holds the whole numbers from border c - 1 up to below border c.
    first, last = np.concatenate(([low], inner)), np.concatenate((inner - 1, [high]))
    middle = first / 2.0 + last / 2.0
    return inner, middle, np.maximum(middle - first, last - middle)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, tables: Workspace | None = None
) -> DataFrame:
    """The ``k`` highest inner products of every query row with the other rows, exactly.

    query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; a query
    with fewer partners gets all. Scores beyond 64 bits count as the nearest end of
    that range. Vectors meet only those of their own length.
    Rows that share a query's vec_id aren't its partners; if they differ, the
    smallest vector is the query. No valid rows give no rows.

    1. Of equal vectors only the k + 1 smallest ids can appear in any result, so
       the others needn't be compared.
    2. Blocks of queries meet blocks of approximations (one byte a component),
       whose cells bound each product from both sides: once for the k best lower
       bounds of each block, and again for what reaches the k-th best of all.
    3. Exact vectors are read in the order of their bounds: a first few per query
       give an exact k-th score, then all those whose bound still reaches it.
    """
    tables = tables or Workspace(vectors.sparkSession, "nearest")
    raw = tables.save(integer_vectors(vectors, scale))
    same = Window.partitionBy("v").orderBy("vec_id")
    apart = raw.withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n")
    inner, centre, half = _borders(raw)
    base = tables.save(_packed(apart, inner))
    asked = raw.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = tables.save(_packed(asked, inner).select(F.col("vec_id").alias("query_id"), "dim", F.col("vec").alias("query")))
    tables.drop(raw)

    n_blocks = max(1, -(-base.count() // VECTORS_PER_BLOCK))
    n_query_blocks = max(1, -(-queries.count() // QUERIES_PER_BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = base.select("vec_id", "dim", "code", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block"))
    left = left.withColumn("query_block", every(n_query_blocks))

    def met(asked: DataFrame, scan: Callable, result: str) -> DataFrame:
        right = asked.withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(n_query_blocks)).cast("int"))
        right, on = right.withColumn("block", every(n_blocks)), ["dim", "block", "query_block"]
        return tables.save(left.groupBy(*on).cogroup(right.groupBy(*on)).applyInPandas(scan, result))

    def bounds(codes: pd.DataFrame, asked: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
        """Queries slice by slice, with upper and lower bounds of their products and what is their own row."""
        if len(codes) and len(asked):
            ids, dim = codes["vec_id"].to_numpy(), int(codes["dim"].iloc[0])
            cells = np.frombuffer(b"".join(codes["code"]), np.uint8).reshape(len(ids), dim)
            middle, width = centre[cells].T, half[cells].T
            for start in range(0, len(asked), 256):
                part = asked.iloc[start:start + 256]
                q = np.frombuffer(b"".join(part["query"]), "<f8").reshape(len(part), dim)
                # Where sums overflow the bounds are infinite or not numbers, and settle nothing.
                with np.errstate(over="ignore", invalid="ignore"):
                    near, slack = q @ middle, np.abs(q) @ (width + ROUNDING * np.abs(middle))
                high, low = (np.clip(x, LEAST, MOST) for x in (near + slack, near - slack))
                yield part, high, low, part["query_id"].to_numpy()[:, None] == ids[None, :]

    def best_lows(codes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "low": np.zeros(0)})]
        for part, _, low, own in bounds(codes, asked):
            low = np.nan_to_num(np.where(own, -np.inf, low), nan=-np.inf, neginf=-np.inf)
            at = max(0, low.shape[1] - k)
            some = np.partition(low, at, axis=1)[:, at:]
            found = pd.DataFrame({"query_id": np.repeat(part["query_id"].to_numpy(), some.shape[1]), "low": some.ravel()})
            out.append(found[np.isfinite(found["low"])])
        return pd.concat(out)

    def within(codes: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "high": np.zeros(0)})]
        for part, high, _, own in bounds(codes, asked):
            least = part["least"].fillna(-np.inf).to_numpy(np.float64)
            i, j = np.nonzero(~(high < least[:, None]) & ~own)
            out.append(pd.DataFrame({
                "query_id": part["query_id"].to_numpy()[i], "vec_id": codes["vec_id"].to_numpy()[j],
                "high": np.nan_to_num(high[i, j], nan=np.inf, posinf=np.inf),
            }))
        return pd.concat(out)

    lows = met(queries, best_lows, "query_id long, low double")
    by_low = Window.partitionBy("query_id").orderBy(F.desc("low"))
    least = lows.withColumn("_n", F.row_number().over(by_low)).where(F.col("_n") == k).select("query_id", F.col("low").alias("least"))
    pairs = met(queries.join(least, "query_id", "left"), within, "query_id long, vec_id long, high double")
    by_high = Window.partitionBy("query_id").orderBy(F.desc("high"), "vec_id")
    left_over = tables.save(pairs.withColumn("place", F.row_number().over(by_high)))

    def exact(some: DataFrame) -> DataFrame:
        # Equal vectors keep up to k + 1 rows, and ids that several vectors share give several.
        near = some.join(base.select("vec_id", "dim", "vec"), "vec_id").join(queries, ["query_id", "dim"])
        return near.select("query_id", "vec_id", inner_product("vec", "query").alias("score"))

    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = tables.save(exact(left_over.where(F.col("place") <= FIRST_READS * k)))
    sure = first.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") == k).select(
        "query_id", F.col("score").alias("_sure")
    )
    more = left_over.where(F.col("place") > FIRST_READS * k).join(sure, "query_id", "left")
    second = exact(more.where(F.col("_sure").isNull() | (F.col("high") >= F.col("_sure"))).select("query_id", "vec_id"))
    ranked = first.unionByName(second).distinct().withColumn("rank", F.row_number().over(by_score).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
