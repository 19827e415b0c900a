"""Substring dedup: repeated passages through MinHash bands over paragraphs and anchored runs of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import attach, maybe_in, require_columns
from pairloom.llm.near_links import linked_components
from pairloom.llm.shingles import WIDTH, MinHash, _combined, word_marks
from pairloom.session import Workspace

# A link at similarity 0.75 misses every band once in 95 times, at 0.85 once in 6,000, at 0.9 once in 300,000.
BANDS, ROWS = 12, 4
PER_CENT = 75
MISS = 1e-4
# Shorter paragraphs aren't compared.
MIN_WORDS = 8
# Repeated paragraphs in a row make a passage; shorter passages stay.
MIN_PASSAGE = 18
# One sentence end in so many, chosen by its word, ends a paragraph within a line.
BREAK_EVERY = 3
# Every run of so many words that repeats holds the same anchor with MIN_PASSAGE words after it.
SURE = 50
WINDOW = SURE - MIN_PASSAGE + 1
_LOW = np.uint64((1 << 24) - 1)
_ENDS = np.frombuffer(b".!?", np.uint8)
# Bytes of neighbouring texts that are worked on together; a longer text is worked on alone.
TOGETHER = 500_000


def _keys(marks: np.ndarray) -> np.ndarray:
    """Marks with their places in the low bits, so that minima tell where they stand; of equal ones the last is least."""
    return (marks & ~_LOW) | (_LOW - (np.arange(len(marks), dtype=np.uint64) & _LOW))


def _places_of(keys: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where the least keys stand that were found at or after ``begin``."""
    begin = begin.astype(np.uint64)
    return (begin + (((_LOW - (keys & _LOW)) - begin) & _LOW)).astype(np.int64)


def _least(marks: np.ndarray, window: int) -> np.ndarray:
    """Position of the least mark in each run of ``window`` marks (in all, if they are fewer), the last of equal ones."""
    keys, span = _keys(marks), 1
    window = min(window, len(marks))
    while span < window:
        step = min(span, window - span)
        keys, span = np.minimum(keys[:-step], keys[step:]), span + step
    return _places_of(keys, np.arange(len(keys)))


def _joined(marks: np.ndarray, first: np.ndarray, last: np.ndarray, final: np.ndarray) -> np.ndarray:
    """Ends of pieces, with neighbouring pieces under MIN_WORDS words joined and cut anew where a word's mark is least.

    ``final`` pieces end a text and aren't joined to the next. Such a cut is the
    least of the MIN_WORDS - 1 words on both sides and not nearer to the ends of
    the joined pieces, so all parts hold MIN_WORDS words and the cuts depend on
    nothing but the words around them.
    """
    short = last - first < MIN_WORDS
    inner = short & np.append(short[1:], False) & ~final
    ends = last[~inner]
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1]))
    # Regions that hold several of the old pieces.
    several = np.diff(np.searchsorted(last, ends, "right"), prepend=0) > 1
    around = 2 * MIN_WORDS - 1
    if len(marks) < around or not several.any():
        return ends
    least = _least(marks, around)
    cuts = np.flatnonzero(least == np.arange(len(least)) + MIN_WORDS - 1) + MIN_WORDS - 1
    region = np.searchsorted(ends, cuts, "right")
    far = several[region] & (cuts - starts[region] >= MIN_WORDS) & (ends[region] - cuts >= MIN_WORDS)
    return np.union1d(ends, cuts[far])


def _split(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of lower-cased text begin and end, and their marks; each different word is hashed once."""
    chars = np.frombuffer(data, np.uint8)
    blank = np.ones(len(chars) + 2, bool)
    blank[1:-1] = (chars == 32) | (chars - np.uint8(9) < 5)
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, stops = edges[::2], edges[1::2]
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(stops - starts)))
    joined = [None, pa.py_buffer(offsets), pa.py_buffer(data.translate(None, b" \t\n\v\f\r"))]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), joined).dictionary_encode()
    return starts, stops, word_marks(words.dictionary.to_numpy(zero_copy_only=False))[words.indices.to_numpy()]


class Paragraphs:
    """The paragraphs of some texts that are long enough: their first words, lengths and shingles.

    Words are numbered through all ``texts``, which begin at the words ``begin``;
    ``whose`` and ``number`` tell each paragraph's text and its place there. After
    ``find_runs`` the ``anchors`` are the first words of runs of MIN_PASSAGE words,
    with ``run_ids`` and the texts ``held_by``; ``steps`` are ids of the words from
    each anchor to the next of its text (0 for the last).
    """

    def __init__(self, *texts: bytes | None):
        data = b"\n".join(t or b"" for t in texts).lower()
        starts, stops, self.marks = _split(data)
        chars, n = np.frombuffer(data, np.uint8), len(starts)
        self.begin = np.searchsorted(starts, np.cumsum([0, *(len(t or b"") + 1 for t in texts)]))
        closing = np.isin(chars[stops - 1], _ENDS) & (self.marks % np.uint64(BREAK_EVERY) == 0)
        # Words before which a piece, and a text, has ended.
        cut, over = np.append(False, closing), np.zeros(n + 1, bool)
        over[self.begin] = True
        cut[np.searchsorted(starts, np.flatnonzero(chars == 10))] = True
        cut[n], cut[0] = True, False
        last = np.flatnonzero(cut)
        first = np.concatenate((np.zeros(1, np.int64), last[:-1])) if len(last) else last
        if len(last):
            last = _joined(self.marks, first, last, over[last])
            first = np.concatenate((np.zeros(1, np.int64), last[:-1]))
        long = np.flatnonzero(last - first >= MIN_WORDS)
        self.first, self.last = first[long], last[long]
        self.whose = self._text_of(self.first)
        self.number = long - np.searchsorted(first, self.begin[self.whose])
        self.shingles = _combined(self.marks, WIDTH) if n >= WIDTH else np.zeros(0, np.uint64)
        self.ids = self._ids(self.first, self.last)

    def _text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, words, "right") - 1

    def find_runs(self) -> Paragraphs:
        begin, starts = self.begin[:-1], np.diff(self.begin) - MIN_PASSAGE + 1
        found = [np.zeros(0, np.int64)]
        many, few = starts >= WINDOW, (starts > 0) & (starts < WINDOW)
        if many.any():
            least = _least(self.shingles, WINDOW)
            # Windows that lie within one text.
            change = np.zeros(len(least) + 1, np.int8)
            change[begin[many]] = 1
            change[begin[many] + starts[many] - WINDOW + 1] = -1
            least = least[np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
            found.append(least[np.append(True, least[1:] != least[:-1])])
        if few.any():
            edges = np.stack((begin[few], begin[few] + starts[few]), 1).ravel()
            found.append(_places_of(np.minimum.reduceat(_keys(self.shingles), edges)[::2], begin[few]))
        self.anchors = np.sort(np.concatenate(found))
        self.held_by = self._text_of(self.anchors)
        # Apart from paragraphs of the same words, or a run would count as a copy of the paragraph that it stands in.
        self.run_ids = self._ids(self.anchors, self.anchors + MIN_PASSAGE) ^ np.int64(0x5851F42D4C957F2D)
        self.steps, self.step_words = np.zeros((2, len(self.anchors)), np.int64)
        follows = np.flatnonzero(self.held_by[1:] == self.held_by[:-1])
        self.steps[follows] = self._ids(self.anchors[follows], self.anchors[follows + 1])
        self.step_words[follows] = self.anchors[follows + 1] - self.anchors[follows]
        return self

    def _ids(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Equal word sequences have equal ids: a polynomial of the words from each sequence's start."""
        if not len(first):
            return np.zeros(0, np.int64)
        if not hasattr(self, "sums"):
            forth, _ = _powers(len(self.marks) + 1)
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.marks * forth[:len(self.marks)])))
        # Moving every span to one power makes equal spans equal wherever they stand.
        span = self.sums[last] - self.sums[first]
        x = span * _powers(len(self.marks) + 1)[1][first] ^ (last - first).astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * _MIX
        return (x ^ (x >> np.uint64(29))).view(np.int64)

    def rows(self) -> dict[str, np.ndarray]:
        """Paragraphs, then anchored runs, which are numbered after those of their text."""
        n, m = len(self.ids), len(self.anchors)
        after = np.zeros(len(self.begin) - 1, np.int64)
        np.maximum.at(after, self.whose, self.number + 1)
        place = np.arange(m) - np.searchsorted(self.held_by, self.held_by)
        whose, none = np.concatenate((self.whose, self.held_by)), np.zeros(n, np.int64)
        return {
            "whose": whose, "number": np.concatenate((self.number, after[self.held_by] + place)),
            "first_word": np.concatenate((self.first, self.anchors)) - self.begin[whose],
            "n_words": np.concatenate((self.last - self.first, np.full(m, MIN_PASSAGE))),
            "id": np.concatenate((self.ids, self.run_ids)), "run": np.repeat([False, True], [n, m]),
            "step": np.concatenate((none, self.steps)), "step_words": np.concatenate((none, self.step_words)),
        }

    def places(self, chosen: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into ``shingles`` of all ``chosen`` paragraphs' shingles, and where each paragraph begins there."""
        first = self.first[chosen]
        sizes = self.last[chosen] - first - (WIDTH - 1)
        return _spans(first, sizes), np.cumsum(sizes) - sizes


def _spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1 and so on of each span, one span after the other."""
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary values made of ``sizes`` neighbouring ``values`` each."""
    offsets = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes))) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)


_TABLES: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; as many as the longest text needs are kept."""
    if len(_TABLES[0]) < n:
        size = 1 << n.bit_length()
        for i, base in enumerate((_BASE, _INVERSE)):
            _TABLES[i] = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, base))))
    return _TABLES


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, Paragraphs]]:
    """The texts of ``batch``, some at a time, and how many come before them."""
    done, held, size = 0, [], 0
    for raw in batch.column("text").cast(pa.binary()).to_numpy(zero_copy_only=False):
        text = raw or b""
        if held and size + len(text) > TOGETHER:
            yield done, Paragraphs(*held)
            done, held, size = done + len(held), [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield done, Paragraphs(*held)


def _occurrences(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """doc_id, number, first_word, n_words, id, run, step, step_words and bands of every paragraph and anchored run.

    Bands are of 32 bits; runs are compared by their ids alone and have none.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = MinHash(bands, rows)
        for batch in batches:
            for done, p in _texts(batch):
                every = p.find_runs().rows()
                keys = np.zeros((0, bands), np.int32)
                if len(p.ids):
                    places, starts = p.places()
                    keys = hashing.buckets(hashing.signatures(p.shingles[places], starts)).astype(np.int32)
                ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(~every["run"]) * bands))
                small = {n: pa.array(every[n], pa.int32()) for n in ("number", "first_word", "n_words", "step_words")}
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").take(pa.array(done + every["whose"])),
                    **{n: small[n] for n in ("number", "first_word", "n_words")},
                    "id": pa.array(every["id"], pa.int64()), "run": pa.array(every["run"]),
                    "step": pa.array(every["step"], pa.int64()), "step_words": small["step_words"],
                    "bands": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys.ravel(), pa.int32())),
                })

    return docs.mapInArrow(
        run, "doc_id long, number int, first_word int, n_words int, id long, run boolean, step long, step_words int, bands array<int>"
    )


def _bit_map(ids: DataFrame, bits: int) -> np.ndarray:
    """A bit map of the column ``id``, whose size doesn't depend on the data."""
    spot = F.pmod(F.col("id"), F.lit(bits)) + 1
    maps = ids.groupBy(F.bitmap_bucket_number(spot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")
    ).toPandas()
    filled = np.zeros(bits // 8, np.uint8)
    for part, some in zip(maps["part"], maps["bits"], strict=True):
        filled[(part - 1) * 4096:part * 4096] = np.frombuffer(some, np.uint8)
    return filled


def _details(docs: DataFrame, ids: DataFrame, holders: DataFrame, bands: int, rows: int) -> DataFrame:
    """id, signature and full shingle set of the paragraphs that may be in ``ids``.

    ``holders`` (id, doc_id) names a document of each paragraph; only texts that are
    one are read again. Workers leave other paragraphs out by a bit map, whose size
    doesn't depend on the data.
    """
    bits = 1 << 26
    needed = holders.join(ids.hint("merge"), "id", "left_semi").select("doc_id")
    docs = maybe_in(docs, "doc_id", needed, "_maybe").where("_maybe")
    shared = docs.sparkSession.sparkContext.broadcast(_bit_map(ids, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, table = MinHash(bands, rows), shared.value
        for batch in batches:
            for _, p in _texts(batch):
                place = p.ids % bits
                maybe = np.flatnonzero((table[place >> 3] >> (place & 7)) & 1)
                # Equal paragraphs once.
                maybe = maybe[np.unique(p.ids[maybe], return_index=True)[1]]
                if not len(maybe):
                    continue
                places, starts = p.places(maybe)
                items, whose = p.shingles[places], np.repeat(np.arange(len(maybe)), np.diff(np.append(starts, len(places))))
                signatures = hashing.signatures(items, starts).astype("<u4")
                order = np.lexsort((items, whose))
                items = items[order]
                fresh = np.append(True, (items[1:] != items[:-1]) | (whose[1:] != whose[:-1]))
                sizes = np.bincount(whose[fresh], minlength=len(maybe))
                yield pa.record_batch({
                    "id": pa.array(p.ids[maybe], pa.int64()), "signature": _binary(signatures.ravel(), np.full(len(maybe), bands * rows)),
                    "set": _binary(items[fresh].astype("<u8"), sizes),
                })

    return docs.select("text").mapInArrow(run, "id long, signature binary, set binary")


def _fringes(docs: DataFrame, ends: DataFrame) -> DataFrame:
    """doc_id, first_word, before, after: 32-bit marks of the words around the runs that may be in ``ends`` (doc_id, id).

    ``before`` goes backwards. WINDOW words on each side reach past the end of any
    run that repeats, as otherwise another anchor would follow.
    """
    bits = 1 << 26
    shared = docs.sparkSession.sparkContext.broadcast(_bit_map(ends, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for done, p in _texts(batch):
                place = p.find_runs().run_ids % bits
                maybe = ((table[place >> 3] >> (place & 7)) & 1).astype(bool)
                anchors, whose, small = p.anchors[maybe], p.held_by[maybe], p.marks.astype("<u4")
                after = anchors + MIN_PASSAGE
                left = np.minimum(WINDOW, anchors - p.begin[whose])
                right = np.minimum(WINDOW, p.begin[whose + 1] - after)
                # The words before a run are numbered backwards.
                back = len(small) - 1 - _spans(len(small) - anchors, left)
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id").take(pa.array(done + whose, pa.int64())),
                    "first_word": pa.array(anchors - p.begin[whose], pa.int32()),
                    "before": _binary(small[back], left), "after": _binary(small[_spans(after, right)], right),
                })

    wanted = maybe_in(docs, "doc_id", ends.select("doc_id").distinct(), "_maybe").where("_maybe").select("doc_id", "text")
    return wanted.mapInArrow(run, "doc_id long, first_word int, before binary, after binary")


def _alike(pairs: DataFrame) -> DataFrame:
    """doc_id, number, component_id, left and right: by how many equal words each run extends like its kept copy."""
    def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        sizes = pc.binary_length(column).to_numpy() // 4
        table = np.zeros((len(sizes), WINDOW + 1), "<u4")
        table[np.arange(WINDOW + 1) < sizes[:, None]] = np.frombuffer(b"".join(column.to_pylist()), "<u4")
        return table, sizes

    def alike(one: pa.Array, other: pa.Array) -> pa.Array:
        (left, n), (right, m) = words(one), words(other)
        same = (left == right) & (np.arange(WINDOW + 1) < np.minimum(n, m)[:, None])
        # The place after the last word is never the same.
        return pa.array(same.argmin(1), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (alike(batch.column(c), batch.column(f"_{c}")) for c in ("before", "after"))
            yield pa.record_batch({**{c: batch.column(c) for c in ("doc_id", "number", "component_id")}, "left": left, "right": right})

    return pairs.mapInArrow(run, "doc_id long, number int, component_id long, left int, right int")


def _extended(docs: DataFrame, found: DataFrame, total: int, tables: Workspace) -> DataFrame:
    """``found`` with its runs widened to all neighbouring words that are equal in the kept copy.

    Most runs are followed by the same next anchor over equal words in both
    places, which ``step`` tells. Only the ends of such chains are compared word
    by word. A kept copy becomes as wide as the widest of its copies.
    """
    kept = F.struct("doc_id", "number") == F.struct("_kept.doc_id", "_kept.number")
    same = F.when(F.col("step_words").__gt__(0) & (F.col("step") == F.col("_kept.step")), F.col("step_words")).otherwise(0)
    runs = found.where(F.col("run") & ~kept).withColumn("_wide", F.greatest("n_words", same))
    chain = Window.partitionBy("doc_id", "_kept.doc_id", F.col("first_word") - F.col("_kept.first_word")).orderBy("first_word")
    until = F.lag(F.col("first_word") + F.col("_wide")).over(chain)
    follows = F.lead("first_word").over(chain)
    runs = tables.save(runs.withColumn("_end", F.coalesce(until < F.col("first_word"), F.lit(True))
        | F.coalesce(follows > F.col("first_word") + F.col("_wide"), F.lit(True))))
    ends = tables.save(runs.where("_end").select("doc_id", "id", "number", "first_word", "component_id", "n_copies", "_kept"))
    both = ends.select("doc_id", "id").unionByName(ends.select(F.col("_kept.doc_id").alias("doc_id"), "id"))
    fringes = tables.save(_fringes(docs, both))
    ours = ends.join(fringes, ["doc_id", "first_word"])
    places = ends.select("component_id", "n_copies", F.col("_kept.doc_id").alias("doc_id"), F.col("_kept.first_word").alias("first_word")).distinct()
    theirs = tables.save(places.join(fringes, ["doc_id", "first_word"]).select(
        "component_id", "n_copies", F.col("before").alias("_before"), F.col("after").alias("_after")
    ))
    sides = _alike(attach(ours.drop("n_copies"), theirs, "component_id", "n_copies", total).where(F.col("_before").isNotNull()))
    wide = runs.select("doc_id", "number", "component_id", "_kept", (F.col("_wide") - F.col("n_words")).alias("_more")).join(
        sides.drop("component_id"), ["doc_id", "number"], "left"
    )
    wide = tables.save(wide.select(
        "doc_id", "number", "_kept", F.coalesce("left", F.lit(0)).alias("left"),
        F.greatest("_more", F.coalesce("right", F.lit(0))).alias("right"),
    ))
    tables.drop(runs, ends, fringes, theirs)
    first = wide.groupBy(F.col("_kept.doc_id").alias("doc_id"), F.col("_kept.number").alias("number")).agg(
        F.max("left").alias("left"), F.max("right").alias("right")
    )
    found = found.join(wide.drop("_kept").unionByName(first), ["doc_id", "number"], "left")
    left, right = F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0))
    return found.withColumn("n_words", F.col("n_words") + left + right).withColumn("first_word", F.col("first_word") - left)


def repeated_passages(
    docs: DataFrame, tables: Workspace | None = None, bands: int = BANDS, rows: int = ROWS, per_cent: int = PER_CENT,
    miss: float = MISS, min_passage: int = MIN_PASSAGE,
) -> DataFrame:
    """Paragraphs that repeat, nearly or exactly, in another document, as part of a passage.

    doc_id, number, first_word, n_words, passage_words, component_id, n_copies,
    keep_doc_id, removed: ``first_word`` numbers the words of the text, parted by
    ASCII blanks, from 0. Paragraphs end with a line, or within a line at
    sentence ends that their last word selects, so a passage put into another
    text falls into the same paragraphs there. Neighbouring pieces under 8 words,
    as of verse, lists or code, are joined and cut where the words say; a single
    one between longer ones isn't compared. Paragraphs are linked if their sets of five-word shingles have
    100 * intersection >= per_cent * union (A-Z lower-cased).

    Besides, the least shingle in every WINDOW places is an anchor, and the
    MIN_PASSAGE words from an anchor are a run, whatever lines and sentences they
    stand in; equal runs are linked and widened to both sides as far as words
    stay equal. Every passage of SURE words that repeats exactly, if SURE is not
    lowered, holds a whole run. Runs are numbered after the paragraphs and may
    overlap them and each other.

    A component in two or more documents keeps its first paragraph or run by
    doc_id and number; the others are ``removed``. ``passage_words`` counts the
    words under neighbouring repeated paragraphs and runs; passages under
    ``min_passage`` words are left out. doc_id must identify a row; rows without
    one, and null and empty texts, have no paragraphs.

    Equal paragraphs share a 64-bit id and are compared once. Texts are read
    twice, and those with ends of runs once more; only bands, runs and candidates
    are shuffled.
    """
    docs = require_columns(docs, ["doc_id", "text"]).where(F.col("doc_id").isNotNull())
    tables = tables or Workspace(docs.sparkSession, "passages")
    # Paragraphs and runs are stored apart, so banding doesn't read the many runs.
    every = seen = tables.save(_occurrences(docs, bands, rows), "run")
    size = [F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")]
    once = tables.save(seen.where(~F.col("run")).groupBy("id").agg(*size))
    items = seen.where(~F.col("run")).select("id", F.col("bands").alias("buckets"))
    details = lambda ids: _details(docs, ids, once.select("id", F.col("_low").alias("doc_id")), bands, rows)
    found = linked_components(items, details, bands, rows, per_cent, miss, tables)
    found = tables.save(found.select(F.col("node").alias("id"), "component"))

    counts = seen.where("run").groupBy("id").agg(*size).withColumn("component", F.lit(None).cast("long"))
    counts = counts.where(F.col("_low") != F.col("_high")).unionByName(once.join(found, "id", "left"))
    known = counts.where(F.col("component").isNotNull() | (F.col("_low") != F.col("_high")))
    known = tables.save(known.select("id", "_n", F.coalesce("component", "id").alias("component_id")))
    total, seen = max(1, seen.count()), seen.drop("bands")
    near = maybe_in(seen, "id", known, "_maybe").where("_maybe").drop("_maybe")
    placed = tables.save(attach(near, known, "id", "_n", total).where(F.col("component_id").isNotNull()).drop("_n"))
    tables.drop(every, once, found, known)
    place = F.struct("doc_id", "number", "first_word", "step")
    groups = placed.groupBy("component_id").agg(
        F.count(F.lit(1)).alias("n_copies"), F.min(place).alias("_kept"), F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")
    ).where(F.col("_low") != F.col("_high")).select("component_id", "n_copies", "_kept")
    rows_ = attach(placed, tables.save(groups), "component_id", "n_copies", total).where(F.col("n_copies").isNotNull())
    # A run that overlaps the kept one stays with it, as in a text that repeats one word.
    apart_ = (F.col("doc_id") != F.col("_kept.doc_id")) | (F.col("first_word") - F.col("_kept.first_word") >= MIN_PASSAGE)
    removed = F.when(F.col("run"), apart_).otherwise(F.struct("doc_id", "number") != F.struct("_kept.doc_id", "_kept.number"))
    rows_ = _extended(docs, tables.save(rows_.withColumn("removed", removed)), total, tables)
    order = Window.partitionBy("doc_id").orderBy("first_word", "number")
    end = F.col("first_word") + F.col("n_words")
    covered = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = rows_.withColumn("_new", F.coalesce((F.col("first_word") - covered >= MIN_WORDS).cast("int"), F.lit(1)))
    runs = runs.withColumn("_fresh", F.greatest(F.lit(0), end - F.greatest("first_word", F.coalesce(covered, F.lit(0)))))
    runs = runs.withColumn("_run", F.sum("_new").over(order))
    runs = runs.withColumn("passage_words", F.sum("_fresh").over(Window.partitionBy("doc_id", "_run")))
    return runs.where(F.col("passage_words") >= min_passage).select(
        "doc_id", "number", "first_word", "n_words", "passage_words", "component_id", "n_copies",
        F.col("_kept.doc_id").alias("keep_doc_id"), "removed",
    )
