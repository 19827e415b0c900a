"""Periodic runs of words, found in tiles per period octave and stitched by document and period."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import bits60, maybe_in, require_columns
from pairloom.session import Workspace

LEAST_WORDS = 12
# A tile answers for this many words, or for TILE_PERIODS least periods of its octave if they are more.
TILE_WORDS, TILE_PERIODS = 4096, 16
# Tiles of longer documents are dealt over tasks; others are solved where the document is read.
SPREAD_WORDS = 1 << 20
# Words of tiles solved at once, and places compared at once.
AT_ONCE = 1 << 18
# Borders with more periods to look at go to the Z-function at once.
FEW = 4
MARKS = ["mark", "mark2"]
FRAGMENT = "mark long, mark2 long, period long, low long, high long"
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Octave(NamedTuple):
    """Periods from ``least`` to below 2 * ``least``, and how their runs are looked for.

    A run of period p holds at least max(p, 12 - p) places whose word comes again
    p words later. So it holds a border (a multiple of ``stride``) with ``block``
    such places from it on, and around a border it is followed for ``reach``
    places either way, which is beyond the next border and long enough to tell a run.
    The first border of a stretch, which finds its beginning, follows it to its end.
    """

    least: int

    @property
    def places(self) -> int:
        return min(max(p, LEAST_WORDS - p) for p in (range(self.least, 2 * self.least) if self.least < 8 else (self.least,)))

    @property
    def block(self) -> int:
        return max(4, self.least // 2)

    @property
    def stride(self) -> int:
        return self.places - self.block + 1

    @property
    def reach(self) -> int:
        return max(2 * self.least, LEAST_WORDS)


class Tile(NamedTuple):
    """``words`` of a document from word ``first`` on, and the places ``low`` to below ``high`` it answers for."""

    document: int
    first: int
    low: int
    high: int
    words: np.ndarray


def octaves(n: int) -> Iterator[Octave]:
    """Octaves of the periods that a run within ``n`` words can have."""
    least = 1
    while max(LEAST_WORDS, 2 * least) <= n:
        yield Octave(least)
        least *= 2


def tiles(document: int, words: np.ndarray, octave: Octave, tile_words: int = TILE_WORDS) -> Iterator[Tile]:
    step = max(tile_words, TILE_PERIODS * octave.least)
    for low in range(0, len(words), step):
        first, end = max(0, low - octave.reach), low + step + 2 * octave.least + octave.reach
        yield Tile(document, first, low, min(low + step, len(words)), words[first:end])


def word_numbers(words: list[bytes]) -> np.ndarray:
    """The same number for equal words, in order of appearance."""
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))


def z_function(text: list[int]) -> np.ndarray:
    """For each place, how many elements from there on equal the beginning of ``text``; at 0 all."""
    n = len(text)
    z, left, right = [0] * n, 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and text[k] == text[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    if n:
        z[0] = n
    return np.array(z, np.int64)


def _blocks(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words (a power of two) from each place on; the last places are of no use."""
    x = words.astype(np.uint64) * _STEP
    x ^= x >> np.uint64(31)
    have = 1
    while have < size:
        x[:-have] = (x[:-have] ^ (x[have:] >> np.uint64(7))) * _STEP + x[have:] * _MIX
        x ^= x >> np.uint64(29)
        have *= 2
    return x


def _same_blocks(words: np.ndarray, borders: np.ndarray, ends: np.ndarray, octave: Octave) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of borders whose block comes again at a period of the octave, with that period, by border."""
    least, size = octave.least, octave.block
    hashes = np.concatenate((_blocks(words, size), np.zeros(2 * least, np.uint64)))
    further = np.lib.stride_tricks.sliding_window_view(hashes, least)
    step = max(1, AT_ONCE // least)
    for at in range(0, len(borders), step):
        c = borders[at:at + step]
        inside = np.arange(least)[None, :] <= (ends[at:at + step] - size - c - least)[:, None]
        i, j = np.nonzero((further[c + least] == hashes[c][:, None]) & inside)
        if len(i):
            yield at + i, j + least


def _agree(words: np.ndarray, c: np.ndarray, p: np.ndarray, begin: np.ndarray, end: np.ndarray, reach: int) -> np.ndarray:
    """Places around each border ``c`` whose word comes again ``p`` words later, up to ``reach`` either way."""
    out = np.zeros(len(c), np.int64)
    steps, size = np.arange(reach), max(1, AT_ONCE // reach)
    for at in range(0, len(c), size):
        part = slice(at, at + size)
        for places in (c[part, None] + steps, c[part, None] - 1 - steps):
            further = places + p[part, None]
            inside = (places >= begin[part, None]) & (further < end[part, None])
            differs = (words[np.where(inside, places, 0)] != words[np.where(inside, further, 0)]) | ~inside
            out[part] += np.where(differs.any(axis=1), differs.argmax(axis=1), reach)
    return out


def _around(words: np.ndarray, c: int, periods: np.ndarray, octave: Octave, begin: int, end: int) -> Iterator[tuple[int, int, int, bool]]:
    """(period, low, high, primitive) of the stretches around border ``c``, by Z-functions from the border both ways.

    A period that a shorter one divides isn't primitive: its run belongs to that one.
    """
    reach, least = octave.reach, octave.least
    after = z_function(words[c:min(end, c + 2 * least + reach)].tolist())
    ahead = np.minimum(after[periods], reach)
    back = max(begin, c - reach)
    pattern, behind = words[back:c][::-1].tolist(), words[back:min(end, c + 2 * least)][::-1].tolist()
    before = z_function([*pattern, -1, *behind])
    # The word before c + p, counted from the end of what was reversed.
    ago = np.minimum(before[len(pattern) + 1 + min(end, c + 2 * least) - c - periods], len(pattern))
    good = ahead + ago >= np.maximum(periods, LEAST_WORDS - periods)
    if not good.any():
        return
    divided = np.zeros(2 * least + 1, bool)
    reached = after[:least + 1] + np.arange(min(len(after), least + 1))
    for q in range(1, len(reached)):
        if reached[q] >= 2 * q and not divided[q]:
            divided[2 * q:min(int(reached[q]), 2 * least) + 1:q] = True
    for p, b, f in zip(periods[good].tolist(), ago[good].tolist(), ahead[good].tolist(), strict=True):
        yield p, c - b, c + f, not divided[p]


def _end(words: np.ndarray, c: int, p: int, end: int) -> int:
    """The first place from ``c`` on whose word doesn't come again ``p`` words later."""
    step = 256
    while c + p < end:
        until = min(c + step, end - p)
        differs = words[c:until] != words[c + p:until + p]
        if differs.any():
            return c + int(differs.argmax())
        c, step = until, 2 * step
    return c


def solve(some: list[Tile], octave: Octave, regular: dict[int, list[tuple[int, int]]] | None = None) -> np.ndarray:
    """Rows (document, period, low, high) of the tiles, in words of the document.

    From ``low`` to below ``high`` each word comes again a period later. A row is
    such a stretch as far as its tile holds it; parts of one stretch overlap or
    touch. ``regular`` names stretches of words (first, after the last) of the
    documents that have a period of at most a block: what comes again within one
    belongs to that period, so it isn't looked at again.
    """
    if not some:
        return np.zeros((0, 4), np.int64)
    sizes = np.array([len(t.words) for t in some])
    offsets = np.cumsum(sizes) - sizes
    words = np.concatenate([t.words for t in some])
    firsts = [-(-t.low // octave.stride) * octave.stride for t in some]
    own = [np.arange(f, t.high, octave.stride) - t.first + o for f, t, o in zip(firsts, some, offsets.tolist(), strict=True)]
    borders, of = np.concatenate(own), np.repeat(np.arange(len(some)), [len(b) for b in own])
    ends, begins = (offsets + sizes)[of], offsets[of]
    until = np.zeros(len(words), np.int64)
    for t, o in zip(some, offsets.tolist(), strict=True):
        for low, high in (regular or {}).get(t.document, ()):
            low, high = max(0, low - t.first), min(len(t.words), high - t.first)
            if low < high:
                until[o + low:o + high] = np.maximum(until[o + low:o + high], o + high)
    rows, now, reached = [], -1, {}
    for at, periods in _same_blocks(words, borders, ends, octave):
        fresh = borders[at] + periods + octave.block > until[borders[at]]
        at, periods = at[fresh], periods[fresh]
        # Where few periods are named, most are of blocks that come again by chance: those are ruled out together.
        found, starts, counts = np.unique(at, return_index=True, return_counts=True)
        maybe = np.repeat(counts > FEW, counts)
        few = np.flatnonzero(~maybe)
        c, p = borders[at[few]], periods[few]
        maybe[few] = _agree(words, c, p, begins[at[few]], ends[at[few]], octave.reach) >= np.maximum(p, LEAST_WORDS - p)
        for border, start, count in zip(found.tolist(), starts.tolist(), counts.tolist(), strict=True):
            named = periods[start:start + count][maybe[start:start + count]]
            if not len(named):
                continue
            c, begin, end = int(borders[border]), int(begins[border]), int(ends[border])
            if of[border] != now:
                now, reached = of[border], {}
            # A stretch that an earlier border followed to its end isn't followed again.
            named = named[[reached.get(p, -1) <= c for p in named.tolist()]]
            if not len(named):
                continue
            tile = some[now]
            for p, low, high, primitive in _around(words, c, named, octave, begin, end):
                reached[p] = high = _end(words, high, p, end)
                if primitive:
                    rows.append((tile.document, p, low + tile.first - begin, high + tile.first - begin))
    return joined(np.array(rows, np.int64).reshape(-1, 4))


def joined(rows: np.ndarray) -> np.ndarray:
    """(document, period, low, high) with overlapping or touching parts of a document and period made one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1])
    # Parts of one period follow each other by their borders, so their ends rise with their beginnings.
    new = np.concatenate(([True], ~same | (rows[1:, 2] > rows[:-1, 3])))
    starts = np.flatnonzero(new)
    highs = np.maximum.reduceat(rows[:, 3], starts)
    return np.column_stack((rows[starts, :3], highs))


def _solved(groups: dict[int, list[Tile]], marks: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Fragments of the tiles of each octave, the shortest periods first."""
    every = np.zeros((0, 4), np.int64)
    for least, some in sorted(groups.items()):
        octave, regular = Octave(least), {}
        for document, period, low, high in every[every[:, 1] <= octave.block].tolist():
            regular.setdefault(document, []).append((low, high + period))
        rows = solve(some, octave, regular)
        every = np.concatenate((every, rows))
        own = [marks[d] for d in rows[:, 0].tolist()]
        yield pa.record_batch({
            "mark": pa.array([m[0] for m in own], pa.int64()), "mark2": pa.array([m[1] for m in own], pa.int64()),
            **{n: pa.array(rows[:, i]) for i, n in ((1, "period"), (2, "low"), (3, "high"))},
        })


def _with_tile(batch: pa.RecordBatch, tile: Tile | None = None, least: int = 0) -> pa.RecordBatch:
    """``batch`` of fragments, or one row that holds a tile still to be solved."""
    n = batch.num_rows
    values = [None] * 5 if tile is None else [least, tile.first, tile.low, tile.high, tile.words.astype("<i4").tobytes()]
    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["least", "first", "from", "to", "words"]
    return pa.record_batch({
        **{c: batch.column(c) for c in batch.schema.names},
        **{c: pa.array([v] * n, k) for c, v, k in zip(names, values, kinds, strict=True)},
    })


def _fragments(rows: DataFrame, spread_words: int, tile_words: int, tables: Workspace) -> DataFrame:
    """mark, mark2, period, low, high: parts of stretches of all documents."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, groups, held = [], {}, 0
            texts = batch.column("text").cast(pa.binary())
            for raw, *mark in zip(texts, *[batch.column(m).to_pylist() for m in MARKS], strict=True):
                words = word_numbers((raw.as_py() or b"").split())
                far = len(words) > spread_words
                for octave in octaves(len(words)):
                    for tile in tiles(len(marks), words, octave, tile_words):
                        if far:
                            empty = pa.record_batch({
                                "mark": pa.array([mark[0]], pa.int64()), "mark2": pa.array([mark[1]], pa.int64()),
                                **{c: pa.array([None], pa.int64()) for c in ("period", "low", "high")},
                            })
                            yield _with_tile(empty, tile, octave.least)
                        else:
                            groups.setdefault(octave.least, []).append(tile)
                marks.append(tuple(mark))
                held += 0 if far else len(words)
                if held >= AT_ONCE:
                    yield from map(_with_tile, _solved(groups, marks))
                    marks, groups, held = [], {}, 0
            yield from map(_with_tile, _solved(groups, marks))

    def solve_far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tile = Tile(0, row["first"], row["from"], row["to"], np.frombuffer(row["words"], "<i4").astype(np.int32))
                yield from _solved({row["least"]: [tile]}, [(row["mark"], row["mark2"])])

    fields = "least long, first long, from long, to long, words binary"
    found = tables.save(rows.mapInArrow(find, f"{FRAGMENT}, {fields}".replace("from long, to", "`from` long, `to`")))
    far = found.where(F.col("words").isNotNull())
    solved = far.repartition("mark", "least", "first").mapInArrow(solve_far, FRAGMENT)
    return found.where(F.col("words").isNull()).select(*MARKS, "period", "low", "high").unionByName(solved)


def _stitched(fragments: DataFrame) -> DataFrame:
    """mark, mark2, start, length, period of every run, from overlapping or touching parts of its stretch."""
    by = Window.partitionBy(*MARKS, "period").orderBy("low", "high")
    before = F.max("high").over(by.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("_new", F.coalesce(F.col("low") > before, F.lit(True)).cast("int"))
    placed = marked.withColumn("_part", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    whole = placed.groupBy(*MARKS, "period", "_part").agg(F.min("low").alias("start"), F.max("high").alias("_high"))
    length = F.col("_high") - F.col("start") + F.col("period")
    return whole.select(*MARKS, "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(LEAST_WORDS), 2 * F.col("period"))
    )


def _finished(rows: DataFrame) -> DataFrame:
    """doc_id, n_words, runs, collapsed of rows with doc_id, text and runs (null: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = [], []
            for raw, runs in zip(batch.column("text").cast(pa.binary()), batch.column("runs").to_pylist(), strict=True):
                words = (raw.as_py() or b"").split()
                counts.append(len(words))
                if runs:
                    starts, lengths, periods = np.array([[r["start"], r["length"], r["period"]] for r in runs]).T
                    depth = np.zeros(len(words) + 1, np.int64)
                    np.add.at(depth, starts + periods, 1)
                    np.add.at(depth, starts + lengths, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
                texts.append(b" ".join(words).decode())
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "n_words": pa.array(counts, pa.int64()), "runs": batch.column("runs"),
                "collapsed": pa.array(texts, pa.string()),
            })

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "text", "runs").mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    )
    return found.withColumn("runs", F.coalesce("runs", F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")))


def periodic_runs(
    docs: DataFrame, spread_words: int = SPREAD_WORDS, tile_words: int = TILE_WORDS, tables: Workspace | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period by start, then period), collapsed.

    Words are parted by the six ASCII blanks and numbered from 0. A run is a
    stretch of words with smallest period p, at least max(12, 2 * p) long, that no
    neighbouring word extends. ``collapsed`` holds the words that are in no run
    after its first p words, joined by single blanks. Null and blank texts have no
    words, no runs and an empty ``collapsed``. Rows that share a doc_id, null
    included, are told apart by their texts; equal rows give equal results. No rows
    give no rows. Only doc_id and text are read.

    1. A document is cut into overlapping tiles for each octave of periods. Tiles
       are solved on their own: blocks of words that come again at a border name
       the periods, Z-functions from the border both ways say how far they go.
    2. The parts found are shuffled by document and period and stitched.
    3. Only texts with runs are shuffled to meet them.
    """
    docs = require_columns(docs, ["doc_id", "text"])
    tables = tables or Workspace(docs.sparkSession, "periodic")
    digest = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("text", F.lit(""))).cast("binary"))
    rows = docs.select("doc_id", "text", digest.alias("_digest")).select(
        "doc_id", "text", bits60(F.col("_digest")).alias("mark"), bits60(F.substring("_digest", 16, 15)).alias("mark2")
    )
    found = _stitched(_fragments(rows, spread_words, tile_words, tables))
    # A document has fewer runs than words.
    runs = tables.save(
        found.groupBy(*MARKS).agg(F.array_sort(F.collect_set(F.struct("start", "length", "period"))).alias("runs"))
        .withColumn("runs", _by_start(F.col("runs")))
    )
    flagged = maybe_in(rows, "mark", runs, "_maybe")
    none = F.lit(None).cast(runs.schema["runs"].dataType).alias("runs")
    plain = flagged.where(~F.col("_maybe")).select("doc_id", "text", none)
    periodic = flagged.where("_maybe").join(runs.hint("merge"), MARKS, "left").select("doc_id", "text", "runs")
    return _finished(plain.unionByName(periodic))


def _by_start(runs: Column) -> Column:
    """Sorted by start, then period."""
    order = F.array_sort(F.transform(runs, lambda r: F.struct(r["start"], r["period"], r["length"])))
    return F.transform(order, lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
