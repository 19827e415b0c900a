"""Near-duplicate embeddings by int8 tile products with error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import attach
from pairloom.llm.components import components
from pairloom.llm.vectors import blocks, every, matrix, packed
from pairloom.session import Workspace

THRESHOLD = 0.93
# Different vectors of a label in one block; a tile is two blocks.
BLOCK = 8192
# Rows of a tile whose products are held at once, and pairs compared in full precision at once.
SLICE, PAIRS = 256, 8192
LEVELS = 127
TILE = ["group", "low", "high"]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; by a power of two first, so that no square overflows or vanishes."""
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    near_one = np.ldexp(vectors, -power[:, None])
    return near_one / np.sqrt((near_one * near_one).sum(axis=1))[:, None]


def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signed bytes, the step, the length of the rounded vector and the length of its error, per row.

    ``units`` = step * bytes + error, so a product of two rows differs from that of
    the rounded ones by at most length * error' + error * (length' + error').
    """
    step = np.abs(units).max(axis=1, initial=0) / LEVELS
    codes = np.rint(units / step[:, None]).astype(np.int8)
    near = codes * step[:, None]
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    return codes, step, length(near), length(units - near)


def _sides(codes: np.ndarray, step: np.ndarray, length: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices per block: the product of one block's first and another's second is an upper bound."""
    near = codes * step[:, None]
    left = np.column_stack((near, length, error)).astype(np.float32)
    return left, np.column_stack((near, error, length + error)).astype(np.float32)


def rounding(dim: int) -> float:
    """More than 32-bit sums of ``dim + 2`` products of numbers up to 1 can be off."""
    return (dim + 4) * 2.0**-21


def _codes(classes: DataFrame) -> DataFrame:
    """group, block, n_blocks, node, code (signed bytes), step, length, error of every class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None] * batch.num_rows
            for dim in set(batch.column("dim").to_pylist()):
                at = [i for i, d in enumerate(batch.column("dim").to_pylist()) if d == dim]
                found = quantised(unit(matrix(batch.column("vec").take(pa.array(at)).to_pylist())))
                for i, code, *rest in zip(at, found[0], *[x.tolist() for x in found[1:]], strict=True):
                    out[i] = (code.tobytes(), *rest)
            code, step, length, error = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.record_batch({
                **{n: batch.column(n) for n in ("group", "block", "n_blocks", "node")},
                "code": pa.array(code, pa.binary()), "step": pa.array(step, pa.float64()),
                "length": pa.array(length, pa.float64()), "error": pa.array(error, pa.float64()),
            })

    fields = classes.select("group", "block", "n_blocks", "node", "dim", "vec")
    return fields.mapInArrow(run, "group string, block int, n_blocks int, node long, code binary, step double, length double, error double")


def _halves(tile: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The rows of the tile's two blocks, which may be the same."""
    low, high = tile["low"].iloc[0], tile["high"].iloc[0]
    return tile[tile["block"] == low], tile[tile["block"] == high]


def _candidates(threshold: float):
    """The rows of a tile that are in a pair which may reach the threshold."""
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        left, right = _halves(tile)
        parts = lambda rows: (
            matrix(rows["code"], np.int8), *(rows[c].to_numpy() for c in ("step", "length", "error"))
        )
        hit_left, hit_right = np.zeros(len(left), bool), np.zeros(len(right), bool)
        if len(left) and len(right):
            first, second = _sides(*parts(left))[0], _sides(*parts(right))[1]
            least, one_block = threshold - rounding(first.shape[1]), left["block"].iloc[0] == right["block"].iloc[0]
            for start in range(0, len(left), SLICE):
                may = first[start:start + SLICE] @ second.T >= least
                if one_block:
                    np.fill_diagonal(may[:, start:], False)
                hit_left[start:start + SLICE] |= may.any(axis=1)
                hit_right |= may.any(axis=0)
        out = pd.concat([left[hit_left], right[hit_right]])[[*TILE, "node", "block"]]
        return out.drop_duplicates("node")

    return run


def _verified(threshold: float):
    """node, links (rows it is linked to in the tile) and to (a linked node, enough to join all linked ones).

    Bounds of the quantised product settle most pairs; those between them are
    compared in full precision.
    """
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        left, right = _halves(tile)
        out = [pd.DataFrame({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64), "to": np.zeros(0, np.int64)})]
        if not len(left) or not len(right):
            return out[0]
        one_block = left["block"].iloc[0] == right["block"].iloc[0]
        nodes = np.concatenate((left["node"].to_numpy(), [] if one_block else right["node"].to_numpy())).astype(np.int64)
        shift = 0 if one_block else len(left)
        a, b = unit(matrix(left["vec"])), unit(matrix(right["vec"]))
        (a_code, a_step, a_length, a_error), (b_code, b_step, b_length, b_error) = quantised(a), quantised(b)
        a_near, b_near = a_code * a_step[:, None], b_code * b_step[:, None]
        a_rows, b_rows = left["n"].to_numpy(np.int64), right["n"].to_numpy(np.int64)
        links, root, ends = np.zeros(len(nodes), np.int64), np.arange(len(nodes)), []
        margin = rounding(a.shape[1])
        for start in range(0, len(left), SLICE):
            part = slice(start, min(start + SLICE, len(left)))
            near = a_near[part] @ b_near.T
            slack = a_length[part, None] * b_error + a_error[part, None] * (b_length + b_error) + margin
            linked = near - slack >= threshold
            i, j = np.nonzero((near + slack >= threshold) & ~linked)
            for at in range(0, len(i), PAIRS):
                x, y = i[at:at + PAIRS], j[at:at + PAIRS]
                linked[x, y] = (a[part][x] * b[y]).sum(axis=1) >= threshold
            if one_block:
                np.fill_diagonal(linked[:, start:], False)
            links[part] += linked @ b_rows
            if not one_block:
                links[shift:] += a_rows[part] @ linked
            for own in np.flatnonzero(linked.any(axis=1)).tolist():
                others = np.flatnonzero(linked[own]) + shift
                apart, first = np.unique(root[others], return_index=True)
                new = apart != root[start + own]
                if new.any():
                    ends += [(start + own, int(o)) for o in others[first[new]]]
                    root[np.isin(root, apart[new])] = root[start + own]
        hit = np.flatnonzero(links)
        out.append(pd.DataFrame({"node": nodes[hit], "links": links[hit], "to": None}))
        if ends:
            x, y = np.array(ends).T
            out.append(pd.DataFrame({"node": nodes[x], "links": 0, "to": nodes[y]}))
        return pd.concat(out).astype({"to": "Int64"})

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, tables: Workspace | None = None) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows are linked if their labels are equal and not null, their vectors equally
    long and their cosine, in double precision, is at least ``threshold``.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest vec_id reachable (its own included), and ``kept`` says that it is the
    row's own. A vector that is null, empty or zero, or holds null or non-finite
    components, and a row without label, is linked to nothing. Rows that share a
    vec_id are vectors of their own; rows without one take part, but don't name a
    component and aren't kept. No rows give no rows. Only vec_id, label and
    embedding are read.

    1. Equal vectors of a label are one class with its number of rows.
    2. The classes of a label are dealt into blocks, and each two blocks of it meet
       as a tile of one-byte codes. From the products of codes and the length of
       each vector's rounding error follows a bound for every pair; a tile passes
       on only its rows that have a pair which may reach the threshold.
    3. Those rows meet again per tile with their full vectors. Pairs that the
       bounds leave open are compared in full precision; a tile gives out a count
       per row and as many links as join its rows, never all pairs.
    """
    tables = tables or Workspace(vectors.sparkSession, "links")
    known = packed(vectors, ["vec_id", "label"])
    takes = (F.col("largest") > 0) & F.col("label").isNotNull()
    group = F.concat_ws(":", F.col("dim").cast("string"), F.col("label").cast("string"))
    mark = F.sha2(F.concat(group.cast("binary"), F.lit("|").cast("binary"), "vec"), 256)
    rows = tables.save(known.select("vec_id", "dim", "vec", F.when(takes, group).alias("group"), F.when(takes, mark).alias("mark")))
    found = rows.where(F.col("mark").isNotNull()).groupBy("mark").agg(
        F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"), F.first("group").alias("group"),
        F.first("dim").alias("dim"), F.first("vec").alias("vec"),
    )
    numbered = tables.save(found.withColumn("node", F.monotonically_increasing_id()))
    sizes = tables.save(numbered.groupBy("group").agg(F.count(F.lit(1)).alias("classes")))
    total = max(1, numbered.count())
    dealt = attach(numbered, sizes, "group", "classes", total).withColumn("n_blocks", blocks(F.col("classes"), block))
    classes = tables.save(dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")))

    tiles = _codes(classes).withColumn("other", every(F.col("n_blocks"))).select(
        "group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "code", "step", "length", "error",
    )
    maybe = tables.save(tiles.groupBy(*TILE).applyInPandas(_candidates(threshold), "group string, low int, high int, node long, block int"))
    full = maybe.join(classes.select("node", "vec", "n"), "node")
    linked = tables.save(full.groupBy(*TILE).applyInPandas(_verified(threshold), "node long, links long, to long"))
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    edges = linked.where(F.col("to").isNotNull()).select(F.col("node").alias("a"), F.col("to").alias("b"))
    joined = components(edges, tables)

    named = classes.select("node", "mark", "n", "least").join(counts, "node", "left").join(joined, "node", "left")
    named = tables.save(named.withColumn("component", F.coalesce("component", "node")))
    names = tables.save(named.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("_n")))
    result = attach(named, names, "component", "_n", total).select(
        "mark", "n", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    every_row = attach(rows.select("vec_id", "mark"), tables.save(result), "mark", "n", max(1, rows.count()))
    component = F.when(F.col("mark").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return every_row.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
