"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import BITS_PER_ROUND, WORD, attach, bits60, require_columns
from pairloom.session import Workspace

BITS = 60
# More sources than this are joined by a shuffle with hot sources kept out of it, not by a broadcast.
FEW_SOURCES = 100_000


def source_sizes(sized: DataFrame, weights: Sequence[float], tables: Workspace) -> DataFrame:
    """One row per source: source, source_size, weight; weights repeat in code-point order, null last."""
    sums = tables.save(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    # One row per source: ranges are sorted apart and numbered from their offsets.
    ranged = tables.save(sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_from", F.sum("_n").over(Window.orderBy("_range")) - F.col("_n"))
    within = Window.partitionBy("_range").orderBy(F.col("source").asc_nulls_last())
    place = F.col("_from") + F.row_number().over(within) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    return tables.save(
        ranged.join(offsets, "_range")
        .select("source", "source_size", F.get(cycle, (place % len(weights)).cast("int")).alias("weight"))
    )


def targets(sources: DataFrame, share: float, most: float, tables: Workspace) -> DataFrame:
    """``sources`` with ``target``: ``share`` times all sizes dealt by weight, each at most ``most`` times its size.

    What a source can't take is dealt anew by weight among the others until none
    is above. Each round reads one row of sums from the table of sources.
    """
    if share > most:
        raise ValueError("the share can't exceed what every source may repeat")
    level = -1.0
    cap = F.col("source_size") * F.lit(float(most))
    budget = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    while True:
        full = F.col("weight") * F.lit(level) > cap
        sums = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)).alias("used"), F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("left")
        ).first()
        if not sums["left"]:
            break
        fresh = (budget - sums["used"]) / sums["left"]
        if fresh <= level:
            break
        level = fresh
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(max(0.0, level))))


def mix(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, tables: Workspace | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, repeats, taken.

    ``size`` counts the words of the text (null or empty: 0), ``repeats`` says how
    often the mix takes the document, ``taken`` = size * repeats. A source repeats
    all its documents as often as its target allows and then those whose hash is
    below a threshold, so that its words come within half a document of the
    target. Only rows that share doc_id and text are decided together. A null source is a source. No rows give no rows.

    The threshold comes from sums of words by source and hash bucket: the bucket
    in which the budget ends is cut into finer ones by the next hash bits, and
    only its rows are read again, until single hashes are left. Rows are never
    sorted, and a source that holds most rows is combined on the map side.
    """
    tables = tables or Workspace(docs.sparkSession, "mix")
    rows, plan = _plan(require_columns(docs, ["doc_id", "text", "source"]), weights, share, most, tables)
    return _planned(rows, plan).withColumn("repeats", _repeats()).select(
        "doc_id", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken")
    )


def _planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the plan of their source; without a broadcast, hot sources aren't shuffled on."""
    if "_rows" not in plan.columns:
        return rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    # A null source is a key of its own.
    safe = lambda c: F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit("null"))
    total = plan.agg(F.sum("_rows")).first()[0] or 0
    named = plan.withColumn("_key", safe("_source")).drop("_source")
    return attach(rows.withColumn("_key", safe("source")), named, "_key", "_rows", total).drop("_key", "_rows")


def _repeats() -> Column:
    return F.col("whole") + (F.col("spot") < F.col("below")).cast("long")


def hash_spot(doc_id: Column, text: Column) -> Column:
    """A hash of id and text, so rows that share an id (null included) are decided one by one."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    return bits60(F.md5(F.concat_ws(":", *parts).cast("binary")))


def _plan(
    docs: DataFrame, weights: Sequence[float], share: float, most: float, tables: Workspace
) -> tuple[DataFrame, DataFrame]:
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    rows = tables.save(docs.select("doc_id", "source", words.alias("size"), hash_spot(F.col("doc_id"), F.col("text")).alias("spot")))
    sources = tables.save(targets(source_sizes(rows, weights, tables), share, most, tables))
    few = sources.count() <= FEW_SOURCES
    plan = thresholds(rows, sources, few, tables).select(
        F.col("source").alias("_source"), "source_size", "target", "whole", "below"
    )
    if few:
        return rows, F.broadcast(plan)
    counts = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_rows"))
    return rows, tables.save(plan.join(counts, F.col("source").eqNullSafe(F.col("_source"))).drop("source"))


def _spot(depth: int) -> Column:
    return F.shiftright("spot", BITS - depth)


def thresholds(rows: DataFrame, sources: DataFrame, few: bool, tables: Workspace) -> DataFrame:
    """``sources`` with ``whole`` repeats of everything and ``below``, the hash threshold of one more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    open_ = tables.save(
        sources.withColumn("whole", whole)
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("cell", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long"))
    )
    depth = 0
    while depth < BITS:
        deeper = min(BITS, depth + BITS_PER_ROUND)
        # Only rows of the boundary cells go on.
        left = rows
        if depth:
            cells = open_.select(F.col("source").alias("_source"), "cell")
            left = rows.join(
                F.broadcast(cells) if few else cells,
                F.col("source").eqNullSafe(F.col("_source")) & (_spot(depth) == F.col("cell")), "left_semi"
            )
        sums = left.groupBy("source", _spot(deeper).alias("fine")).agg(F.sum("size").alias("n"))
        running = Window.partitionBy("source").orderBy("fine")
        named = sums.withColumn("upto", F.sum("n").over(running)).withColumnRenamed("source", "_source")
        found = (
            open_.join(named, F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("_start", F.col("before") + F.col("upto") - F.col("n"))
            .where(F.col("_source").isNull() & F.col("fine").isNull() | (F.col("_start") <= F.col("wanted")))
        )
        # The last cell that starts within the budget is the boundary.
        last = found.groupBy("source").agg(F.max(F.struct("fine", "_start", "n")).alias("_last"))
        kept = open_.withColumnRenamed("source", "_key").join(last, F.col("_key").eqNullSafe(F.col("source"))).drop("source")
        fresh = tables.save(kept.select(
            F.col("_key").alias("source"), "source_size", "weight", "target", "whole", "wanted",
            F.coalesce("_last.fine", F.lit(0)).alias("cell"), F.coalesce("_last._start", F.lit(0)).alias("before"),
            F.coalesce("_last.n", F.lit(0)).alias("held"),
        ))
        open_, depth = fresh, deeper
    # One hash is left: it is taken if that comes nearer to what is wanted.
    nearer = F.col("before") * 2 + F.col("held") <= F.col("wanted") * 2
    below = F.when(F.col("wanted") > 0, F.col("cell") + nearer.cast("long")).otherwise(F.lit(0).cast("long"))
    return open_.withColumn("below", below).drop("cell", "before", "held", "wanted")


def mixed(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, tables: Workspace | None = None
) -> DataFrame:
    """``docs`` with all its columns, each row as often as the mix takes it; texts aren't shuffled."""
    tables = tables or Workspace(docs.sparkSession, "mix")
    _, plan = _plan(require_columns(docs, ["doc_id", "text", "source"]), weights, share, most, tables)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("source").alias("source"),
        hash_spot(F.col("doc_id"), F.col("text")).alias("spot"),
    )
    taken = _planned(rows, plan).withColumn("_times", _repeats().cast("int"))
    again = taken.where(F.col("_times") > 0).select("_row", F.explode(F.expr("sequence(1, _times)")).alias("_time"))
    return again.select("_row.*")
