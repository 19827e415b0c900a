"""Blocked vector search: exact results from matrix products over bounded blocks.

Both operators cut their inputs into blocks of bounded size, bring pairs of
blocks together with an equi-join on block numbers, and let NumPy compare the
vectors of two blocks. Only qualifying pairs leave a task; the full set of
pairs never exists as rows. Vectors are ``ids array<int>, weights
array<double>`` (sparse) and ``embedding array<float>`` (dense).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import dot
from .relational import top_rows
from .skew import hot_keys, join_spread
from .tfidf import sparse_dot

POSTINGS_PER_BLOCK = 1_000_000
ROWS_PER_BLOCK = 32_768
QUERIES_PER_BLOCK = 4_096
NODES_PER_BLOCK = 8_192
# Within a block, this many vectors of one side are scored at a time.
SLICE = 256
PIVOTS = 32
# Sparse products from here on are found by shared terms, those below by the embeddings.
TEXT = 0.5
# Room left below a threshold for the caller's rounding.
MARGIN = 2e-4


def _blocks(df: DataFrame, rows_limit: int) -> int:
    rows, postings = df.select(F.count(F.lit(1)), F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()
    return max(1, math.ceil(rows / rows_limit), math.ceil(postings / POSTINGS_PER_BLOCK))


def _spread_over(df: DataFrame, key: str, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
    """Give each row its own block and one copy per block of the other side."""
    return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int")).withColumn(
        other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
    )


def _flat(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, term id and weight of every posting in the block."""
    sizes = np.fromiter((0 if v is None else len(v) for v in frame["ids"]), dtype="int64", count=len(frame))
    rows = np.repeat(np.arange(len(frame)), sizes)
    if not len(rows):
        return rows, np.empty(0, "int64"), np.empty(0)
    kept = [v for v in frame["ids"] if v is not None and len(v)]
    weights = [v for v in frame["weights"] if v is not None and len(v)]
    return rows, np.concatenate(kept).astype("int64"), np.concatenate(weights).astype("float64")


def nearest(
    index: DataFrame, queries: DataFrame, k: int = 20, row_key: str = "row_id", query_key: str = "query_id",
    pad: bool = True,
) -> DataFrame:
    """Exact top ``k`` index rows per query by cosine of unit sparse vectors.

    Returns (query_key, row_key, score, rank); scores are rounded to 9 digits
    and ties go to the lower row key. With ``pad`` rows of similarity 0 fill up
    to ``k``, as brute-force search does; without it they are left out. Each
    pair of blocks passes on at most ``k`` rows per query.
    """
    n_index, n_query = _blocks(index, ROWS_PER_BLOCK), _blocks(queries, QUERIES_PER_BLOCK)
    left = _spread_over(index.select(row_key, "ids", "weights"), row_key, "ib", n_index, "qb", n_query)
    right = _spread_over(queries.select(query_key, "ids", "weights"), query_key, "qb", n_query, "ib", n_index)
    row_type, query_type = index.schema[row_key].dataType, queries.schema[query_key].dataType
    schema = f"{query_key} {query_type.simpleString()}, {row_key} {row_type.simpleString()}, score double"

    def best(docs: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if docs.empty or asked.empty:
            return _stacked([query_key, row_key, "score"], [])
        docs = docs.sort_values(row_key, ignore_index=True)
        row_keys = docs[row_key].to_numpy(dtype=object)
        take, postings = min(k, len(docs)), _flat(docs)
        out = []
        for asked_slice in _slices(asked):
            scores = _sparse_scores(postings, len(docs), asked_slice)
            for number, query in enumerate(asked_slice[query_key]):
                column = scores[:, number]
                cut = np.partition(column, len(column) - take)[len(column) - take]
                candidates = np.flatnonzero(column >= cut)
                order = candidates[np.lexsort((candidates, -column[candidates]))][:take]
                out.append((np.full(len(order), query, dtype=object), row_keys[order], column[order]))
        return _stacked([query_key, row_key, "score"], out)

    local = left.groupBy("ib", "qb").cogroup(right.groupBy("ib", "qb")).applyInPandas(best, schema)
    if not pad:
        local = local.where("score > 0")
    return top_rows(local, [query_key], [F.col("score").desc(), F.col(row_key)], k)


def _stacked(names: list[str], parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
    """One frame of the column arrays of all parts."""
    columns = zip(*parts) if parts else [[np.empty(0, dtype=object)] for _ in names]
    return pd.DataFrame({name: np.concatenate(arrays) for name, arrays in zip(names, columns, strict=True)})


def _slices(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for start in range(0, len(frame), SLICE):
        yield frame.iloc[start:start + SLICE].reset_index(drop=True)


def _sparse_scores(postings: tuple[np.ndarray, ...], n_docs: int, asked: pd.DataFrame) -> np.ndarray:
    """Dense (docs x queries) score block from a block's postings, slice by slice."""
    q_row, q_term, q_weight = _flat(asked)
    terms, q_at = np.unique(q_term, return_inverse=True)
    scores = np.zeros((n_docs, len(asked)))
    if not len(terms):
        return scores
    wanted = np.zeros((len(terms), len(asked)))
    wanted[q_at, q_row] = q_weight
    d_row, d_term, d_weight = postings
    at = np.minimum(np.searchsorted(terms, d_term), len(terms) - 1)
    known = terms[at] == d_term
    d_row, at, d_weight = d_row[known], at[known], d_weight[known]
    step = max(1, 4_000_000 // len(asked))
    for start in range(0, len(d_row), step):
        part = slice(start, start + step)
        rows, firsts = np.unique(d_row[part], return_index=True)
        sums = np.add.reduceat(wanted[at[part]] * d_weight[part, None], firsts, axis=0)
        scores[rows] += sums
    return np.round(scores, 9)


def scored_above(
    base: DataFrame, comp: DataFrame, threshold: float, weights: tuple[float, float] = (0.7, 0.3),
    key: str = "text",
) -> DataFrame:
    """Text pairs whose weighted score can reach ``threshold``.

    Inputs have ``key``, ``embedding``, ``ids`` and ``weights``; texts without
    an embedding cannot score and are left out. Returns (base_<key>,
    comp_<key>, embedding_similarity, tfidf_similarity), unrounded; the caller
    rounds and applies the threshold, so a small margin is left here.

    A pair's sparse vectors are either at least ``TEXT`` alike, or not:

    * Those that are share a term of both prefixes (`prefix_pairs`); only such
      pairs are put together and scored.
    * For the others the sparse score is below ``TEXT``, so the embeddings have to
      reach the rest. Vectors are assigned to the nearest of a few pivots; by the
      triangle inequality of angles, cells that can't reach it are never compared.
      Other cells meet in blocks, where the sparse score is taken only for pairs
      whose embeddings reach it.

    Inputs are read several times, so hand in checkpointed frames.
    """
    base, comp = (side.where(F.col("embedding").isNotNull()) for side in (base, comp))
    # At most PIVOTS vectors come to the driver.
    chosen = base.orderBy(F.xxhash64(key), key).limit(PIVOTS).select("embedding").collect()
    spark = base.sparkSession
    schema = (
        f"base_{key} string, comp_{key} string, embedding_similarity double, tfidf_similarity double"
    )
    if not chosen:
        return spark.createDataFrame([], schema)
    pivots = np.array([r["embedding"] for r in chosen], dtype="float64")
    pivots /= np.maximum(np.linalg.norm(pivots, axis=1, keepdims=True), 1e-12)
    alike = _scored_alike(base, comp, threshold, weights, key)
    base, comp = _in_cells(base, key, pivots), _in_cells(comp, key, pivots)
    plan = _cell_plan(spark, base, comp, pivots, threshold, weights)

    # The plan has at most PIVOTS squared rows.
    left = base.join(F.broadcast(plan.withColumnRenamed("bc", "cell")), "cell").select(
        key, "embedding", "ids", "weights", F.col("cell").alias("bc"), "cc",
        F.pmod(F.xxhash64(key), F.col("bn")).alias("bb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cn") - 1)).alias("cb"),
    )
    right = comp.join(F.broadcast(plan.withColumnRenamed("cc", "cell")), "cell").select(
        key, "embedding", "ids", "weights", "bc", F.col("cell").alias("cc"),
        F.pmod(F.xxhash64(key), F.col("cn")).alias("cb"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bn") - 1)).alias("bb"),
    )
    margin = threshold - MARGIN

    def compare(b: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(b) and len(c):
            vectors, b_keys = _dense(b), b[key].to_numpy(dtype=object)
            for part in _slices(c):
                dense = vectors @ _dense(part).T
                near = weights[0] * dense + weights[1] * TEXT >= margin
                rows = np.flatnonzero(near.any(axis=1))
                if not len(rows):
                    continue
                sparse = _sparse_scores(_flat(b.iloc[rows]), len(rows), part)
                dense = dense[rows]
                i, j = np.nonzero(near[rows] & (weights[0] * dense + weights[1] * sparse >= margin))
                found.append((b_keys[rows[i]], part[key].to_numpy(dtype=object)[j], dense[i, j], sparse[i, j]))
        return _stacked([f"base_{key}", f"comp_{key}", "embedding_similarity", "tfidf_similarity"], found)

    grid = ["bc", "bb", "cc", "cb"]
    near = left.groupBy(*grid).cogroup(right.groupBy(*grid)).applyInPandas(compare, schema)
    # Pairs near in both ways come from both sides.
    return near.unionByName(alike).dropDuplicates([f"base_{key}", f"comp_{key}"])


def prefix_pairs(base: DataFrame, comp: DataFrame, least: float, key: str = "text") -> DataFrame:
    """Pairs (base_<key>, comp_<key>) that hold all whose unit sparse vectors have a product of ``least`` or more.

    Terms are ordered by their number of texts, the rarest first. The prefix of a
    vector ends where what follows is shorter than ``least``. Vectors whose
    prefixes share no term have all common terms behind the prefix of one of them,
    so their product is below ``least``. Frequent terms come last and are in few
    prefixes; those that still hold many rows are spread.
    """
    sides = {
        name: side.where(F.size(F.coalesce("ids", F.array().cast("array<int>"))) > 0)
        .select(F.col(key).alias(f"{name}_{key}"), F.explode(F.arrays_zip("ids", "weights")).alias("_p"))
        .select(f"{name}_{key}", F.col("_p.ids").alias("term"), F.col("_p.weights").alias("w"))
        for name, side in (("base", base), ("comp", comp))
    }
    df = sides["base"].select("term").union(sides["comp"].select("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    prefixes = {}
    for name, postings in sides.items():
        rest = Window.partitionBy(f"{name}_{key}").orderBy(F.desc("df"), F.desc("term")).rowsBetween(Window.unboundedPreceding, 0)
        known = postings.join(df, "term").withColumn("_rest", F.sum(F.col("w") * F.col("w")).over(rest))
        prefixes[name] = known.where(F.col("_rest") >= least * least - 1e-9).select(f"{name}_{key}", "term")
    hot = hot_keys(prefixes["base"], ["term"])
    return join_spread(prefixes["base"], prefixes["comp"], ["term"], "inner", hot).drop("term").distinct()


def _scored_alike(base: DataFrame, comp: DataFrame, threshold: float, weights: tuple[float, float], key: str) -> DataFrame:
    """The pairs of `prefix_pairs` that reach the threshold, with both scores."""
    pairs = prefix_pairs(base, comp, TEXT, key)
    for name, side in (("base", base), ("comp", comp)):
        vectors = side.select(F.col(key).alias(f"{name}_{key}"), *[F.col(c).alias(f"_{name}_{c}") for c in ("embedding", "ids", "weights")])
        pairs = pairs.join(vectors, f"{name}_{key}")
    dense = dot(F.col("_base_embedding"), F.col("_comp_embedding"))
    sparse = sparse_dot(*[F.col(f"_{s}_{c}") for s in ("base", "comp") for c in ("ids", "weights")])
    scored = pairs.select(
        f"base_{key}", f"comp_{key}", dense.alias("embedding_similarity"), F.round(sparse, 9).alias("tfidf_similarity")
    )
    total = weights[0] * F.col("embedding_similarity") + weights[1] * F.col("tfidf_similarity")
    return scored.where(total >= threshold - MARGIN)


def _dense(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["embedding"].to_numpy()).astype("float64")


def _in_cells(df: DataFrame, key: str, pivots: np.ndarray) -> DataFrame:
    """Add the nearest pivot, the angle to it and the vector length."""
    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            vectors = _dense(frame)
            length = np.linalg.norm(vectors, axis=1)
            cosines = (vectors @ pivots.T) / np.maximum(length, 1e-12)[:, None]
            cell = np.argmax(cosines, axis=1)
            angle = np.arccos(np.clip(cosines[np.arange(len(cell)), cell], -1, 1))
            yield frame.assign(cell=cell.astype("int32"), angle=angle, length=length)

    fields = df.select(key, "embedding", "ids", "weights")
    ddl = f"{key} string, embedding array<float>, ids array<int>, weights array<double>"
    return fields.mapInPandas(assign, f"{ddl}, cell int, angle double, length double")


def _cell_plan(spark, base, comp, pivots, threshold, weights) -> DataFrame:
    """Cell pairs that can reach the threshold, with the number of blocks of each cell."""
    def stats(side: DataFrame) -> dict:
        # One row per cell, at most PIVOTS.
        rows = side.groupBy("cell").agg(F.max("angle"), F.max("length"), F.count(F.lit(1))).collect()
        return {r[0]: (r[1], r[2], math.ceil(r[3] / NODES_PER_BLOCK)) for r in rows}

    between = np.arccos(np.clip(pivots @ pivots.T, -1, 1))
    rows = []
    comp_stats = stats(comp)
    for b, (b_angle, b_length, b_blocks) in stats(base).items():
        for c, (c_angle, c_length, c_blocks) in comp_stats.items():
            gap = max(0.0, between[b, c] - b_angle - c_angle)
            cosine = math.cos(gap)
            dense = cosine * b_length * c_length if cosine > 0 else 0.0
            if weights[0] * dense + weights[1] * TEXT >= threshold - 1e-3:
                rows.append((b, c, b_blocks, c_blocks))
    return spark.createDataFrame(rows, "bc int, cc int, bn bigint, cn bigint")
