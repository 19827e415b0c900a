"""A stored inverted index of sparse unit vectors, searched where it lies.

The rows of the index are cut into segments of bounded size. A segment is a few
files with one row per term: the row numbers and weights of the term's postings,
and the largest weight in every block of neighbouring rows. The files are bucketed
by segment, so at query time Spark reads them as they are and shuffles only the
queries.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import Workspace, shared_folder
from . import skew
from .relational import top_rows

POSTINGS_PER_SEGMENT = 250_000
# Neighbouring rows of a segment that share one maximum per term.
BLOCK = 64
# Blocks scored before the first look at the k-th score; then twice as many, and so on.
FIRST_BLOCKS = 8
# Segments searched per query to learn a k-th score that the others must reach.
FIRST_SEGMENTS = 2
MOST_BUCKETS = 4096
# Scores are rounded to this many digits; bounds get more room than rounding and sums take.
DIGITS = 9
ROOM = 1e-8
LISTS = (
    "segment int, term_id int, highest double, rows array<int>, weights array<double>, blocks array<int>, "
    "starts array<int>, most array<double>"
)


@dataclass(frozen=True)
class InvertedIndex:
    """The folder of an index; ``lists`` reads it in place."""

    spark: SparkSession
    path: str
    n_buckets: int
    row_type: str
    n_segments: int

    @property
    def lists(self) -> DataFrame:
        """segment, term_id (-1: the row keys of the segment), its postings and block maxima."""
        name = f"pairloom_lists_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        if not self.spark.catalog.tableExists(name):
            # Bucketed files keep their layout only as a table; the path stays outside the warehouse.
            self.spark.sql(
                f"create table {name} ({LISTS}, keys array<{self.row_type}>) using parquet "
                f"clustered by (segment) into {self.n_buckets} buckets location '{self.path}/lists'"
            )
        return self.spark.table(name)


def _heaviest(ids: str, weights: str) -> Column:
    """The term with the largest weight, the smallest id of equals."""
    return F.element_at(ids, F.array_position(weights, F.array_max(weights)).cast("int"))


def write_index(
    vectors: DataFrame, path: str | None = None, row_key: str = "row_id", per_segment: int = POSTINGS_PER_SEGMENT
) -> InvertedIndex:
    """Index of ``vectors`` (``row_key``, ``ids``, ``weights``; positive weights) below ``path``.

    Rows with null or no ids can't score and are only kept as fillers. Without a
    path the index goes to the session's shared folder. Rows are sorted by their
    heaviest term before they are cut into segments and blocks, so that neighbours
    have terms in common and maxima are telling; equal heaviest terms are cut
    where they must be, so no term makes a segment larger than others.
    """
    spark = vectors.sparkSession
    path = path or f"{shared_folder(spark)}/pairloom-index-{uuid.uuid4().hex}"
    row_type = vectors.schema[row_key].dataType.simpleString()
    known = vectors.where(F.size(F.coalesce("ids", F.array().cast("array<int>"))) > 0)
    postings = known.select(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    n_segments = max(1, math.ceil(postings / per_segment))
    n_buckets = min(n_segments, MOST_BUCKETS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield _segment(pa.Table.from_batches(held), TaskContext.get().partitionId())

    cut = (
        known.select(F.col(row_key).alias("key"), "ids", "weights", _heaviest("ids", "weights").alias("heaviest"))
        .repartitionByRange(n_segments, "heaviest", F.xxhash64("key")).sortWithinPartitions("heaviest", "key")
    )
    lists = cut.mapInArrow(build, f"{LISTS}, keys array<{row_type}>")
    return _stored(lists, InvertedIndex(spark, path, n_buckets, row_type, n_segments))


def copy_index(index: InvertedIndex, path: str) -> InvertedIndex:
    """The same index below another path."""
    return _stored(index.lists, InvertedIndex(index.spark, path, index.n_buckets, index.row_type, index.n_segments))


def _stored(lists: DataFrame, index: InvertedIndex) -> InvertedIndex:
    """Write the lists of ``index``: a task holds whole segments, so it writes one file per bucket it meets."""
    name = f"pairloom_write_{uuid.uuid4().hex}"
    writer = lists.write.format("parquet").option("path", f"{index.path}/lists").option("compression", "zstd")
    writer.bucketBy(index.n_buckets, "segment").sortBy("term_id").saveAsTable(name)
    # The files stay; only the name that writing them needed goes.
    index.spark.sql(f"drop table {name}")
    return index


def _segment(rows: pa.Table, segment: int) -> pa.RecordBatch:
    """One row per term of the given documents, which are numbered as they come."""
    rows = rows.combine_chunks()
    ids, weights = rows.column("ids").combine_chunks(), rows.column("weights").combine_chunks()
    sizes = np.diff(ids.offsets.to_numpy())
    document = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    term, weight = ids.flatten().to_numpy().astype(np.int32), weights.flatten().to_numpy().astype(np.float64)
    order = np.lexsort((document, term))
    document, term, weight = document[order], term[order], weight[order]
    terms, starts = np.unique(term, return_index=True)
    # A block begins with each term and wherever the block number changes.
    block = document // BLOCK
    first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1]))))
    most = np.maximum.reduceat(weight, first)
    blocks_from = np.searchsorted(first, starts)
    own_start = (first - np.repeat(starts, np.diff([*blocks_from, len(first)]))).astype(np.int32)

    def lists(values: np.ndarray, begins: np.ndarray) -> pa.ListArray:
        # The last row is the list of keys, which has no postings.
        return pa.ListArray.from_arrays(pa.array([*begins.tolist(), len(values), len(values)], pa.int32()), pa.array(values))

    n, keys = len(terms), rows.column("key").combine_chunks()
    none = pa.array([0] * (n + 1) + [len(keys)], pa.int32())
    return pa.record_batch({
        "segment": pa.array([segment] * (n + 1), pa.int32()),
        "term_id": pa.array([*terms.tolist(), -1], pa.int32()),
        "highest": pa.array([*np.maximum.reduceat(weight, starts).tolist(), 0.0], pa.float64()),
        "rows": lists(document, starts), "weights": lists(weight, starts),
        "blocks": lists(block[first].astype(np.int32), blocks_from), "starts": lists(own_start, blocks_from),
        "most": lists(most, blocks_from), "keys": pa.ListArray.from_arrays(none, keys),
    })


class _Segment:
    """The lists of one segment while its queries are answered."""

    def __init__(self, frame: pd.DataFrame):
        named = frame["term_id"] >= 0
        self.keys = np.asarray(frame.loc[~named, "keys"].iloc[0], dtype=object)
        columns = [frame.loc[named, c] for c in ("term_id", "rows", "weights", "blocks", "starts", "most")]
        self.terms = {t: [np.asarray(x) for x in rest] for t, *rest in zip(*columns, strict=True)}
        self.n_blocks = -(-len(self.keys) // BLOCK)

    def best(self, ids: np.ndarray, weights: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and scores: at least the ``k`` best, of those that may reach ``least``.

        Blocks are scored in the order of their bounds, until the next bound is
        below the k-th score found.
        """
        found = [(w, *self.terms[t]) for t, w in zip(ids.tolist(), weights.tolist(), strict=True) if t in self.terms]
        bound, scores, seen = np.zeros(self.n_blocks), np.zeros(len(self.keys)), np.zeros(self.n_blocks, bool)
        for w, _, _, blocks, _, most in found:
            bound[blocks] += w * most
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > max(0.0, least - ROOM)]
        done, step = 0, FIRST_BLOCKS
        while done < len(order) and bound[order[done]] >= least - ROOM:
            chosen = np.zeros(self.n_blocks, bool)
            chosen[order[done:done + step]] = True
            for w, rows, posted, blocks, starts, _ in found:
                at = np.flatnonzero(chosen[blocks])
                ends = np.append(starts, len(rows))
                sizes = ends[at + 1] - ends[at]
                places = np.repeat(ends[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                scores[rows[places]] += w * posted[places]
            seen |= chosen
            done, step = done + step, 2 * step
            reached = np.round(scores[scores > 0], DIGITS)
            if len(reached) >= k:
                least = max(least, float(np.partition(reached, len(reached) - k)[len(reached) - k]))
        scores = np.round(scores, DIGITS)
        hit = np.flatnonzero((scores > 0) & (scores >= least - ROOM))
        order = np.lexsort((np.argsort(np.argsort(self.keys[hit])), -scores[hit]))[:k]
        return hit[order], scores[hit][order]


def _asked(queries: DataFrame, query_key: str) -> DataFrame:
    known = queries.where(F.size(F.coalesce("ids", F.array().cast("array<int>"))) > 0)
    return known.select(F.col(query_key).alias("query"), "ids", "weights")


def _folded(asked: DataFrame) -> DataFrame:
    """``asked`` with ``same``, a digest that queries share whose terms are the same and whose weights differ by rounding only."""
    weights = F.transform("weights", lambda w: F.round(w, 12).cast("string"))
    return asked.withColumn("same", F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>"), weights), 256))


def _asked_lists(index: InvertedIndex, asked: DataFrame) -> DataFrame:
    """The lists of terms that some query has, and the row keys; terms are no more than the vocabulary, which is broadcast too."""
    terms = asked.select(F.explode("ids").alias("term_id")).unionByName(asked.sparkSession.sql("select -1 as term_id")).distinct()
    return index.lists.join(F.broadcast(terms), "term_id", "left_semi")


def _search(index: InvertedIndex, asked: DataFrame, k: int) -> DataFrame:
    """query, key, score: the best ``k`` of each segment that a query is sent to; ``least`` may be null."""
    kind = asked.schema["query"].dataType.simpleString()

    def run(lists: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        parts = [([], [], [])]
        if len(lists) and len(some):
            segment = _Segment(lists)
            for query, ids, weights, least in zip(some["query"], some["ids"], some["weights"], some["least"], strict=True):
                rows, scores = segment.best(ids, weights, k, 0.0 if least is None or math.isnan(least) else least)
                parts.append(([query] * len(rows), segment.keys[rows].tolist(), scores.tolist()))
        columns = [[x for p in part for x in p] for part in zip(*parts, strict=True)]
        return pd.DataFrame({n: pd.Series(c, dtype=object) for n, c in zip(("query", "key", "score"), columns, strict=True)})

    lists, here = _asked_lists(index, asked).drop("highest"), asked.repartition(index.n_buckets, "segment")
    return lists.groupBy("segment").cogroup(here.groupBy("segment")).applyInPandas(
        run, f"query {kind}, key {index.row_type}, score double"
    )


def _bounds(index: InvertedIndex, asked: DataFrame) -> DataFrame:
    """query, segment, bound: what a row of each segment can score at most; only where that is above 0."""
    kind = asked.schema["query"].dataType.simpleString()

    def run(lists: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        if not len(lists) or not len(some):
            return pd.DataFrame({"query": [], "segment": [], "bound": []}, dtype=object)
        terms = dict(zip(lists["term_id"].tolist(), lists["highest"].tolist(), strict=True))
        bounds = [sum(w * terms.get(t, 0.0) for t, w in zip(ids, weights, strict=True)) for ids, weights in zip(some["ids"], some["weights"], strict=True)]
        out = pd.DataFrame({"query": some["query"].to_numpy(), "segment": int(lists["segment"].iloc[0]), "bound": bounds})
        return out[out["bound"] > 0]

    maxima = _asked_lists(index, asked).where("term_id >= 0").select("segment", "term_id", "highest")
    everywhere = asked.withColumn("segment", F.explode(F.sequence(F.lit(0), F.lit(index.n_segments - 1))))
    everywhere = everywhere.repartition(index.n_buckets, "segment")
    return maxima.groupBy("segment").cogroup(everywhere.groupBy("segment")).applyInPandas(
        run, f"query {kind}, segment int, bound double"
    )


def search(
    index: InvertedIndex, queries: DataFrame, k: int = 20, row_key: str = "row_id", query_key: str = "query_id",
    tables: Workspace | None = None,
) -> DataFrame:
    """Exact top ``k`` rows above score 0 per query: (query_key, row_key, score, rank).

    ``queries`` has ``query_key`` (unique) and unit vectors as ``ids`` and
    ``weights``; queries without a known term find nothing. Scores are rounded to
    9 digits and ties go to the lower row key.

    Queries with the same vector are searched once.

    1. Every query learns from the segments' maxima how much each can score.
    2. It is sent to the most promising segments, which give it a k-th score.
    3. It is sent to all others that can reach that score.

    In each step the index is read where it lies and only queries are shuffled.
    """
    tables = tables or Workspace(queries.sparkSession, "search")
    named = tables.save(_folded(_asked(queries, query_key)))
    asked = tables.save(named.groupBy("same").agg(F.min(F.struct("ids", "weights")).alias("v")).select(F.col("same").alias("query"), "v.*"))
    by_bound = Window.partitionBy("query").orderBy(F.desc("bound"), "segment")
    bounds = tables.save(_bounds(index, asked).withColumn("place", F.row_number().over(by_bound)))
    sent = bounds.join(asked, "query").select("query", "segment", "place", "bound", "ids", "weights")
    first = tables.save(_search(
        index, sent.where(F.col("place") <= FIRST_SEGMENTS).select("query", "segment", "ids", "weights", F.lit(0.0).alias("least")), k
    ))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    sure = first.withColumn("_n", F.row_number().over(by_score)).where(F.col("_n") == k).select("query", F.col("score").alias("least"))
    others = sent.where(F.col("place") > FIRST_SEGMENTS).join(sure, "query", "left").where(
        F.col("least").isNull() | (F.col("bound") >= F.col("least") - ROOM)
    )
    second = _search(index, others.select("query", "segment", "ids", "weights", "least"), k)
    found = top_rows(first.unionByName(second), ["query"], [F.desc("score"), F.col("key")], k)
    found = found.select(F.col("query").alias("same"), F.col("key").alias(row_key), "score", "rank")
    askers = named.where(F.col("query").isNotNull()).select(F.col("query").alias(query_key), "same")
    every = skew.join_spread(askers, found, ["same"], "inner", skew.hot_keys(askers, ["same"]), [query_key])
    return every.select(query_key, row_key, "score", "rank")


def padded(found: DataFrame, queries: DataFrame, rows: DataFrame, k: int, row_key: str = "row_id", query_key: str = "query_id") -> DataFrame:
    """``found`` filled up to ``k`` rows per query with the lowest row keys of score 0.

    A query that found fewer than ``k`` rows can't have found all of the 2 * k
    lowest keys but its own, so those, a bounded list, hold enough fillers.
    """
    lowest = rows.select(row_key).orderBy(row_key).limit(2 * k).agg(F.array_sort(F.collect_list(row_key)).alias("_low"))
    hits = found.groupBy(query_key).agg(F.collect_set(row_key).alias("_hit"), F.count(F.lit(1)).cast("int").alias("_n"))
    short = queries.select(query_key).distinct().join(hits, query_key, "left").where(F.coalesce("_n", F.lit(0)) < k)
    none = F.array().cast(f"array<{rows.schema[row_key].dataType.simpleString()}>")
    missing = F.slice(F.array_except(lowest.scalar(), F.coalesce("_hit", none)), 1, F.lit(k) - F.coalesce("_n", F.lit(0)))
    fill = short.select(query_key, F.coalesce("_n", F.lit(0)).alias("_n"), F.posexplode(missing).alias("_at", row_key))
    return found.unionByName(fill.select(query_key, row_key, F.lit(0.0).alias("score"), (F.col("_n") + F.col("_at") + 1).alias("rank")))
