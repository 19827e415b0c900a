"""Hard-negative mining with rotated one-bit codes and exact integer scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import attach
from pairloom.llm.vectors import LEAST, MOST, blocks, every, matrix, packed, products, whole_numbers
from pairloom.session import Workspace

# Vectors that stay in place while anchors pass by, and anchors compared with them at once.
BLOCK, SLICE = 4096, 64
# Anchors that pass by a block in one task.
ANCHORS = 1 << 17
# Bits of each component of a rotated anchor.
QUERY_BITS = 6
# Candidates scored first per wanted result, to know a score that the others must reach.
FIRST_SCORED = 4
# Sums of doubles are off by far less than this share of the two lengths.
ROUNDING = 1e-9
ROW = ["vec_id", "label", "dim", "vec", "code", "along", "off"]


@cache
def rotation(dim: int) -> np.ndarray:
    """A fixed random rotation."""
    drawn, upper = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return drawn * np.sign(np.diag(upper))


def sign_codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each rotated vector: its signs as 64-bit words, its product with the code vector, and what that leaves.

    The code vector has the signs divided by sqrt(dim), so its length is 1 and the
    vector is ``along`` times it plus a rest of length ``off`` at right angles.
    """
    n, dim = vectors.shape
    turned = vectors @ rotation(dim).T
    bits = np.zeros((n, -(-dim // 64) * 64), np.uint8)
    bits[:, :dim] = turned >= 0
    words = np.packbits(bits, axis=1, bitorder="little").view("<u8")
    along = np.abs(turned).sum(axis=1) / np.sqrt(dim)
    off = np.sqrt(np.maximum(0, (turned * turned).sum(axis=1) - along * along))
    return words, along, off


def score_bounds(
    anchors: np.ndarray, words: np.ndarray, along: np.ndarray, off: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimate, lower and upper bound of the products of ``anchors`` with coded vectors.

    A rotated anchor is rounded to a few bits a component, so its product with a
    code vector is a sum of bit counts; the rounding adds at most the sum of its
    errors. What the code leaves of the vector is at right angles to the code, so
    by Cauchy and Schwarz it adds at most ``off`` times what the code leaves of
    the anchor.
    """
    m, dim = anchors.shape
    turned = anchors @ rotation(dim).T
    low = turned.min(axis=1, initial=np.inf)[:, None]
    step = (turned.max(axis=1, initial=-np.inf)[:, None] - low) / ((1 << QUERY_BITS) - 1)
    step = np.where(step > 0, step, 1.0)
    digits = np.rint((turned - low) / step).astype(np.uint8)
    near = low + step * digits
    error = np.abs(turned - near).sum(axis=1)[:, None]
    wide = np.zeros((m, words.shape[1] * 64), np.uint8)
    counts = np.zeros((m, len(words)), np.float64)
    for bit in range(QUERY_BITS):
        wide[:, :dim] = digits >> bit & 1
        plane = np.packbits(wide, axis=1, bitorder="little").view("<u8")
        for w in range(words.shape[1]):
            counts += np.bitwise_count(plane[:, w, None] & words[None, :, w]) * float(1 << bit)
    ones = np.bitwise_count(words).sum(axis=1).astype(np.float64)
    cosine = (2 * (low * ones + step * counts) - near.sum(axis=1)[:, None]) / np.sqrt(dim)
    error = error / np.sqrt(dim)
    length = np.sqrt((turned * turned).sum(axis=1))[:, None]
    rest = np.sqrt(np.maximum(0, length * length - np.maximum(0, np.abs(cosine) - error) ** 2))
    slack = along * error + off * rest + ROUNDING * length * (along + off)
    estimate = along * cosine
    return estimate, estimate - slack, estimate + slack


def _coded(rows: DataFrame) -> DataFrame:
    """``rows`` with the code of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array(batch.column("dim").to_pylist(), np.int64)
            code, along, off = [b""] * len(dims), np.zeros(len(dims)), np.zeros(len(dims))
            for dim in np.unique(dims[dims > 0]).tolist():
                at = np.flatnonzero(dims == dim)
                words, along[at], off[at] = sign_codes(matrix(batch.column("vec").take(pa.array(at)).to_pylist()))
                for i, word in zip(at.tolist(), words, strict=True):
                    code[i] = word.tobytes()
            yield pa.record_batch({
                **{n: batch.column(n) for n in ("vec_id", "label", "dim", "vec")}, "code": pa.array(code, pa.binary()),
                "along": pa.array(along), "off": pa.array(off),
            })

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, label {kind}, dim int, vec binary, code binary, along double, off double")


def _met(base: DataFrame, anchors: DataFrame, scan: Callable, schema: str) -> DataFrame:
    """``scan(block, anchors)`` for every block of ``base`` and the anchors sent to it.

    Both have ``spot``, the block; ``anchors`` has the columns of ``base`` and
    ``below``, ``above``, lists of score limits. A block is read first and kept
    while its anchors stream by, a slice at a time.
    """
    limits = ["below", "above"]
    none = [F.lit(None).cast("array<long>").alias(c) for c in limits]
    both = base.select("spot", F.lit(0).alias("turn"), *ROW, *none).unionByName(
        anchors.select("spot", F.lit(1).alias("turn"), *ROW, *limits)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spot, kept, block = None, [], None
        for batch in batches:
            keys = np.array(batch.column("spot").to_pylist(), dtype=object)
            turns = batch.column("turn").to_numpy()
            edges = np.flatnonzero((keys[1:] != keys[:-1]) | (turns[1:] != turns[:-1])) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                if start == end:
                    continue
                if keys[start] != spot:
                    spot, kept, block = keys[start], [], None
                part = batch.slice(start, end - start)
                if not turns[start]:
                    kept.append(part)
                    continue
                if block is None and kept:
                    block = _read(pa.Table.from_batches(kept))
                    kept = []
                if block is not None:
                    for at in range(0, part.num_rows, SLICE):
                        yield scan(block, _read(pa.Table.from_batches([part.slice(at, SLICE)])))

    return both.repartition("spot").sortWithinPartitions("spot", "turn").mapInArrow(run, schema)


def _read(rows: pa.Table) -> dict:
    names = ("vec_id", "label", "along", "off")
    out = {n: np.array(rows.column(n).to_pylist(), dtype=object if n == "label" else None) for n in names}
    out["vec"] = matrix(rows.column("vec").to_pylist())
    out["code"] = matrix(rows.column("code").to_pylist(), "<u8") if out["vec"].shape[1] else None
    out["below"], out["above"] = rows.column("below").to_pylist(), rows.column("above").to_pylist()
    return out


def _bounds(block: dict, asked: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if block["code"] is None:
        zero = np.zeros((len(asked["vec_id"]), len(block["vec_id"])))
        return zero, zero, zero
    with np.errstate(over="ignore", invalid="ignore"):
        # Scores end where 64 bits do, and so do their bounds.
        return tuple(np.clip(x, LEAST, MOST) for x in score_bounds(asked["vec"], block["code"], block["along"], block["off"]))


def _best(k: int) -> Callable:
    """The ``k`` best rows of a block for each anchor."""
    def scan(block: dict, asked: dict) -> pa.RecordBatch:
        estimate, _, high = _bounds(block, asked)
        ids, out = block["vec_id"], ([], [], [])
        own = asked["vec_id"][:, None] == ids[None, :]
        first = min(FIRST_SCORED * k, len(ids))
        # Bounds that aren't numbers settle nothing.
        promising = np.argpartition(np.where(own, -np.inf, np.nan_to_num(estimate)), len(ids) - first, axis=1)[:, len(ids) - first:]
        for i, some in enumerate(promising):
            query = asked["vec"][i:i + 1]
            some = some[~own[i, some]]
            scores = products(block["vec"][some], query)[:, 0]
            least = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None
            rest = ~own[i] if least is None else ~own[i] & ~(high[i] < least)
            at = np.flatnonzero(rest)
            scores = products(block["vec"][at], query)[:, 0]
            order = np.lexsort((ids[at], ~scores))[:k]
            out[0].append(np.full(len(order), asked["vec_id"][i]))
            out[1].append(ids[at][order])
            out[2].append(scores[order])
        return _batch(("anchor_id", "vec_id", "score"), out)

    return scan


def _in_windows(k: int) -> Callable:
    """The ``k`` best rows of another label in each of an anchor's windows of scores."""
    def scan(block: dict, asked: dict) -> pa.RecordBatch:
        _, low, high = _bounds(block, asked)
        ids, out = block["vec_id"], ([], [], [], [])
        for i, (below, above) in enumerate(zip(asked["below"], asked["above"], strict=True)):
            other = (block["label"] != asked["label"][i]) & (ids != asked["vec_id"][i])
            at = np.flatnonzero(other & ~(high[i] < min(below)) & ~(low[i] > max(above)))
            scores = products(block["vec"][at], asked["vec"][i:i + 1])[:, 0]
            inside = np.flatnonzero((scores >= min(below)) & (scores <= max(above)))
            at, scores = at[inside], scores[inside]
            order = np.lexsort((ids[at], ~scores))
            at, scores = at[order], scores[order]
            for number, (least, most) in enumerate(zip(below, above, strict=True)):
                start = int(np.searchsorted(~scores, ~most))
                found = slice(start, start + int((scores[start:start + k] >= least).sum()))
                out[0].append(np.full(len(ids[at][found]), asked["vec_id"][i]))
                out[1].append(np.full(len(ids[at][found]), number))
                out[2].append(ids[at][found])
                out[3].append(scores[found])
        return _batch(("anchor_id", "place", "vec_id", "score"), out)

    return scan


def _batch(names: tuple[str, ...], parts: tuple[list, ...]) -> pa.RecordBatch:
    return pa.record_batch({
        n: pa.array(np.concatenate(p).astype(np.int64) if p else np.zeros(0, np.int64)) for n, p in zip(names, parts, strict=True)
    })


def mine(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    scale: float = 256, block: int = BLOCK, tables: Workspace | None = None,
) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(scale * component), exact; beyond 64 bits
    they count as the nearest end of that range. An anchor's positives are its
    ``positives`` best other rows of its label, and for each of them the first
    ``negatives`` rows of another label are returned whose score is between
    ``low`` and ``high`` per cent of the positive's (so never if that is below
    0). Ties go to the smaller vec_id. Without any such row there is no result.

    Rows without vec_id or label, with a null vector, or with null or non-finite
    components take no part (nor do those too large to scale in doubles). Only
    vectors of one length are compared. Rows that share an anchor's vec_id aren't
    its partners; the smallest of them (label, vector) is the anchor. Other rows
    count as often as they are there. Only vec_id, label and embedding are read.

    1. Vectors are rotated; their signs, the product with the code vector and the
       length of the rest are stored.
    2. The blocks of an anchor's label, then all blocks, stay in place while
       anchors pass. Bit counts and stored products give an interval that surely
       holds the score; only rows whose interval reaches the wanted scores are
       scored by whole numbers. A block gives at most ``positives`` rows per
       anchor, or ``negatives`` per positive.
    """
    tables = tables or Workspace(vectors.sparkSession, "negatives")
    known = packed(vectors, ["vec_id", "label"], whole_numbers(scale))
    rows = tables.save(_coded(
        known.where(F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("long").alias("vec_id"), "label", "dim", "vec")
    ))
    total = max(1, rows.count())
    group = F.concat_ws(":", F.col("dim").cast("string"), F.col("label").cast("string"))
    grouped = rows.withColumn("group", group)
    sizes = tables.save(grouped.groupBy("group", "dim").agg(F.count(F.lit(1)).alias("n")))
    chosen = rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct(*ROW[1:])).alias("_row")).select("vec_id", "_row.*")
    anchors = tables.save(chosen.withColumn("group", group))

    parts = blocks(F.col("n"), block)
    spot = lambda part, of: F.concat_ws("|", part.cast("string"), F.col(of).cast("string"), F.col("turn").cast("string"))
    turns = blocks(F.lit(float(max(1, anchors.count()))), ANCHORS)
    own_turn = F.pmod(F.xxhash64("vec_id", F.lit(1)), turns).cast("int")
    number = F.pmod(F.xxhash64("vec_id", F.lit(2)), parts).cast("int")
    none = [F.lit(None).cast("array<long>").alias(c) for c in ("below", "above")]

    by_group = sizes.select("group", "n")
    here = attach(grouped, by_group, "group", "n", total).withColumn("_part", number).withColumn("turn", every(turns))
    there = attach(anchors, by_group, "group", "n", total).withColumn("_part", every(parts)).withColumn("turn", own_turn)
    found = _met(
        here.withColumn("spot", spot(F.col("_part"), "group")), there.withColumn("spot", spot(F.col("_part"), "group")).select("*", *none),
        _best(positives), "anchor_id long, vec_id long, score long",
    )
    ranked = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = tables.save(
        found.withColumn("positive_rank", F.row_number().over(ranked)).where(F.col("positive_rank") <= positives)
        .withColumnsRenamed({"vec_id": "positive_id", "score": "positive_score"})
    )

    # Whole scores within the limits: the least is rounded up, the most down.
    percent = lambda p: F.col("positive_score").cast("decimal(20,0)") * F.lit(p)
    windows = best.select(
        F.col("anchor_id").alias("vec_id"), "positive_rank",
        F.ceil(percent(low) / 100).cast("long").alias("least"), F.floor(percent(high) / 100).cast("long").alias("most"),
    ).where(F.col("least") <= F.col("most"))
    wanted = windows.groupBy("vec_id").agg(F.array_sort(F.collect_list(F.struct("positive_rank", "least", "most"))).alias("w"))
    wanted = tables.save(anchors.join(wanted, "vec_id"))
    by_dim = sizes.groupBy("dim").agg(F.sum("n").alias("n"))
    here = attach(rows, by_dim, "dim", "n", total).withColumn("_part", number).withColumn("turn", every(turns))
    there = attach(wanted, by_dim, "dim", "n", total).withColumn("_part", every(parts)).withColumn("turn", own_turn)
    there = there.withColumn("below", F.col("w.least")).withColumn("above", F.col("w.most"))
    found = _met(
        here.withColumn("spot", spot(F.col("_part"), "dim")), there.withColumn("spot", spot(F.col("_part"), "dim")),
        _in_windows(negatives), "anchor_id long, place long, vec_id long, score long",
    )
    ranked = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(ranked).cast("int")).where(F.col("rank") <= negatives)
    places = wanted.select(F.col("vec_id").alias("anchor_id"), F.posexplode("w").alias("place", "_w")).select(
        "anchor_id", F.col("place").cast("long").alias("place"), "_w.positive_rank"
    )
    return top.join(places, ["anchor_id", "place"]).join(best, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", "positive_rank", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
