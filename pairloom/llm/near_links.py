"""Components of near-equal sets: banded candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import attach, maybe_in
from pairloom.llm.components import components
from pairloom.llm.shingles import likely, posterior_bounds
from pairloom.session import Workspace

BATCH = 16
# Members of a bucket that meet others in one task.
BLOCK = 512
# Pairs whose signatures are compared together.
PAIRS = 16_384

# Given a table of ids, at least one row for each of them: id, signature (little-endian 32-bit
# minima) and set (sorted 64-bit fingerprints), both as bytes.
Details = Callable[[DataFrame], DataFrame]


def linked_components(
    items: DataFrame, details: Details, bands: int, rows: int, per_cent: int, miss: float, tables: Workspace
) -> DataFrame:
    """node and component of every item that is linked to another.

    ``items`` has a long ``id`` and ``buckets``, an array of a long bucket key per
    band, or of int keys, which are told apart by the band; an item may come several
    times. Items are linked if 100 * intersection
    >= per_cent * union of their sets. Items that share a bucket are candidates;
    their signatures of ``bands * rows`` minima are compared batch by batch and
    given up once a link is less likely than ``miss``; the rest is verified on
    full sets.

    A bucket of n items isn't expanded into n * n pairs: first each is compared
    with the smallest member, and what that links counts as one. Then members of
    a bucket that are still in different components meet block by block inside
    tasks, each with each, and a task gives out a link only if it joins
    components. So no link between components that a shared bucket finds is left
    out, and the rows made grow with the members and not with their pairs.
    """
    banded = items.select("id", F.posexplode("buckets").alias("band", "bucket"))
    if dict(items.dtypes)["buckets"] == "array<int>":
        banded = banded.withColumn("bucket", F.shiftleft(F.col("band").cast("long"), 32) + F.col("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("centre"), F.max("id").alias("_top"))
    shared = tables.save(shared.where(F.col("centre") != F.col("_top")).drop("_top"))
    near = maybe_in(banded, "bucket", shared, "_maybe").where("_maybe").select("bucket", "band", "id").distinct()
    total = max(1, shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    members = tables.save(attach(near, shared, "bucket", "n", total).where(F.col("centre").isNotNull()))
    ids = tables.save(members.select("id").distinct())
    known = tables.save(details(ids).join(ids, "id", "left_semi").dropDuplicates(["id"]))
    bounds = posterior_bounds(bands * rows, BATCH, per_cent / 100, miss)

    a, b = F.col("centre"), F.col("id")
    pairs = tables.save(members.where(a != b).select(a.alias("a"), b.alias("b")).distinct())
    likely_pairs = tables.save(_likely(pairs, known, bands * rows, bounds))
    links = tables.save(_exact(likely_pairs, known, per_cent))
    tables.drop(pairs, likely_pairs)

    named = components(links, tables).select(F.col("node").alias("id"), "component")
    marked = tables.save(
        members.join(named, "id", "left").select("bucket", "band", "id", F.coalesce("component", "id").alias("label"))
    )
    mixed = marked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    mixed = tables.save(mixed.where(F.col("low") != F.col("high")).select("bucket", "n"))
    rest = tables.save(attach(marked, mixed, "bucket", "n", total).where(F.col("n").isNotNull()))
    tables.drop(marked, members)
    more = tables.save(_crossing(rest, known, bands, rows, per_cent, bounds))
    tables.drop(rest, known, ids, shared, mixed)
    return components(links.unionByName(more), tables)


def _with(pairs: DataFrame, known: DataFrame, what: str) -> DataFrame:
    """``pairs`` with ``what`` of both items as left and right; other items aren't shuffled."""
    for end, name in (("b", "right"), ("a", "left")):
        ids = pairs.select(F.col(end).alias("id")).distinct()
        side = maybe_in(known.select("id", what), "id", ids, "_maybe").where("_maybe")
        pairs = pairs.join(side.select(F.col("id").alias(end), F.col(what).alias(name)), end)
    return pairs


def _likely(pairs: DataFrame, known: DataFrame, size: int, bounds: list[tuple[int, int]]) -> DataFrame:
    """Pairs whose signatures don't give them up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, size) for c in ("left", "right")
            )
            yield batch.select(["a", "b"]).take(pa.array(likely(left, right, bounds)))

    return _with(pairs, known, "signature").mapInArrow(run, "a long, b long")


def _exact(pairs: DataFrame, known: DataFrame, per_cent: int) -> DataFrame:
    """Pairs whose full sets are linked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = ([np.frombuffer(s.as_buffer(), "<u8") for s in batch.column(c)] for c in ("left", "right"))
            keep = [bool(linked(x, [y], per_cent)[0]) for x, y in zip(left, right, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _with(pairs, known, "set").mapInArrow(run, "a long, b long")


def linked(one: np.ndarray, others: list[np.ndarray], per_cent: int) -> np.ndarray:
    """Which of the sorted sets ``others`` are linked to the sorted set ``one``; none is empty."""
    sizes = np.array([len(o) for o in others])
    joined = np.concatenate(others)
    hits = one[np.minimum(np.searchsorted(one, joined), len(one) - 1)] == joined
    both = np.add.reduceat(hits, np.cumsum(sizes) - sizes, dtype=np.int64)
    return 100 * both >= per_cent * (len(one) + sizes - both)


def _crossing(
    rest: DataFrame, known: DataFrame, bands: int, rows: int, per_cent: int, bounds: list[tuple[int, int]]
) -> DataFrame:
    """Links between the labels of each bucket, enough to join all labels that are linked.

    ``rest`` has bucket, band, id, label and n, the size of the bucket. Buckets
    are dealt into blocks and each two blocks of a bucket meet in one place. A
    pair is compared only in the first band that it shares.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = rest.join(known, "id").withColumn("own", F.pmod(F.xxhash64("id", "bucket"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    key = ["bucket", "low", "high"]
    dealt = dealt.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "band", "own", "id", "label",
        "signature", "set",
    ).repartition(*key).sortWithinPartitions(*key, "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in filter(len, batches):
            starts = _groups(batch)
            # The last group of a batch may go on in the next.
            if held and len(starts) and _same(held[0], batch):
                starts = starts[1:]
            elif held:
                yield _edges(_met(held, bands, rows, per_cent, bounds))
                held = []
            if len(starts):
                yield _edges(_met([*held, batch.slice(0, starts[-1])], bands, rows, per_cent, bounds))
                held = []
                batch = batch.slice(starts[-1])
            if len(batch):
                held.append(batch)
        yield _edges(_met(held, bands, rows, per_cent, bounds) if held else [])

    return dealt.mapInArrow(run, "a long, b long")


def _groups(batch: pa.RecordBatch) -> np.ndarray:
    """Where the groups of equal bucket, low and high begin."""
    fresh = np.arange(len(batch)) == 0
    for name in ("bucket", "low", "high"):
        values = batch.column(name).to_numpy()
        fresh[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(fresh)


def _same(one: pa.RecordBatch, other: pa.RecordBatch) -> bool:
    return all(one.column(name)[0] == other.column(name)[0] for name in ("bucket", "low", "high"))


def _met(batches: list[pa.RecordBatch], bands: int, rows: int, per_cent: int, bounds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Links of whole groups that join different labels; the pairs of many groups are compared together."""
    batch = pa.concat_batches(batches)
    if not len(batch):
        return []
    low, high, own, band, ids = (batch.column(c).to_numpy() for c in ("low", "high", "own", "band", "id"))
    roots = batch.column("label").to_numpy().copy()
    packed = np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u4").reshape(len(batch), bands * rows)
    sets = batch.column("set")
    starts = _groups(batch)
    sizes = np.diff(np.append(starts, len(batch)))
    # A row meets the rows after it in its own block, or all rows of the other block, which come last.
    upper = np.repeat(starts + np.add.reduceat(own == low, starts, dtype=np.int64), sizes)
    begin = np.where(low == high, np.arange(len(batch)) + 1, upper)
    counts = np.where(own == low, np.repeat(starts + sizes, sizes) - begin, 0)
    before, at, out = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts))), 0, []
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
        one = np.repeat(np.arange(at, to), counts[at:to])
        other = np.arange(len(one)) + np.repeat(begin[at:to] - (before[at:to] - before[at]), counts[at:to])
        at = to
        apart = roots[one] != roots[other]
        one, other = one[apart], other[apart]
        alive = likely(packed, packed, bounds, one, other)
        one, other = one[alive], other[alive]
        same = (packed[one] == packed[other]).reshape(-1, bands, rows).all(2)
        first = same.argmax(1) == band[one]
        one, other = one[first], other[first]
        cuts = np.flatnonzero(np.diff(one, prepend=-1))
        for i, some in zip(one[cuts].tolist(), np.split(other, cuts[1:]), strict=False):
            some = some[roots[some] != roots[i]]
            if not len(some):
                continue
            linked_to = linked(_set(sets[i]), [_set(sets[j]) for j in some.tolist()], per_cent)
            for j in some[linked_to].tolist():
                if roots[j] != roots[i]:
                    out.append((min(int(ids[i]), int(ids[j])), max(int(ids[i]), int(ids[j]))))
                    roots[roots == roots[j]] = roots[i]
    return out


def _set(packed: pa.Scalar) -> np.ndarray:
    return np.frombuffer(packed.as_buffer(), "<u8")


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})
