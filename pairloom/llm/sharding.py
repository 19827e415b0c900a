"""Sharding by extendible hashing under a byte limit, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import attach, bits60, require_columns
from pairloom.llm.extendible import split_buckets
from pairloom.session import Workspace

LIMIT = 8 << 20
# Counted per row besides the text: the id and the offsets of a file.
ROW_BYTES = 16


def assign_shards(docs: DataFrame, limit: int = LIMIT, tables: Workspace | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, depth, prefix, part, shard, shard_bytes.

    A row has the bytes of its text (null: 0) plus 16. Shards are the buckets of a
    directory over hash-prefix bits of doc_id; only those over ``limit`` bytes are
    split on another bit. Rows that share a doc_id (null included) can't be told
    apart by it; if they alone exceed ``limit``, they fill parts of that bucket,
    numbered from 0 in a running order. A row larger than ``limit`` is the one
    case of a shard above it and stands alone in its part. ``shard`` names prefix
    bits and part. No rows give no rows. Only doc_id and text are read.
    """
    docs = require_columns(docs, ["doc_id", "text"])
    return _assigned(docs, limit, tables or Workspace(docs.sparkSession, "shard"))


def _assigned(docs: DataFrame, limit: int, tables: Workspace, *carried: str) -> DataFrame:
    """`assign_shards` of ``docs``, with the columns ``carried`` kept."""
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long")
    key = bits60(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    rows = tables.save(docs.select("doc_id", *carried, size.alias("n_bytes")).withColumn("key", key))
    entries = tables.save(rows.groupBy("key").agg(F.sum("n_bytes").alias("weight"), F.count(F.lit(1)).alias("copies")))
    placed = tables.save(split_buckets(entries, limit, tables).drop("weight"))
    total = rows.count()
    found = attach(rows, placed, "key", "copies", total)
    fits = found.where(F.col("load") <= limit).withColumn("part", F.lit(0).cast("long"))
    large = tables.save(found.where(F.col("load") > limit))
    if large.isEmpty():
        parts = fits
    else:
        parts = fits.unionByName(_parts(large, limit, tables))
    bits = F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0"))
    name = F.concat_ws("-", F.when(F.col("depth") == 0, F.lit("")).otherwise(bits), F.col("part").cast("string"))
    shard_bytes = F.col("load")
    return parts.select(
        "doc_id", "n_bytes", F.col("depth").cast("int").alias("depth"), "prefix", "part", name.alias("shard"),
        shard_bytes.alias("shard_bytes"), *carried,
    )


def _parts(large: DataFrame, limit: int, tables: Workspace) -> DataFrame:
    """Rows of single keys that exceed the limit, cut into parts.

    Rows of one key are dealt over cells by size and a hash of their place in the
    saved table, so no task holds a whole hot key. A cell fills its own parts: a
    part holds as many rows of the largest size in its cell as fit.
    """
    cell = F.spark_partition_id()
    dealt = tables.save(large.withColumn("_cell", cell))
    order = Window.partitionBy("key", "_cell", "_log").orderBy("n_bytes", "doc_id")
    # Within a power of two of sizes, rows per part follow from the upper bound.
    sized = dealt.withColumn("_log", F.ceil(F.log2(F.col("n_bytes").cast("double"))).cast("int"))
    fit = F.greatest(F.lit(1), F.floor(F.lit(float(limit)) / F.pow(F.lit(2.0), F.col("_log")))).cast("long")
    numbered = tables.save(sized.withColumn("_own", F.floor((F.row_number().over(order) - 1) / fit).cast("long")))
    used = numbered.groupBy("key", "_cell", "_log").agg((F.max("_own") + 1).alias("_used"))
    before = Window.partitionBy("key").orderBy("_cell", "_log").rowsBetween(Window.unboundedPreceding, -1)
    starts = used.withColumn("_start", F.coalesce(F.sum("_used").over(before), F.lit(0))).drop("_used")
    placed = numbered.join(starts, ["key", "_cell", "_log"]).withColumn("part", F.col("_start") + F.col("_own"))
    loads = placed.groupBy("key", "part").agg(F.sum("n_bytes").alias("load"))
    return placed.drop("load").join(loads, ["key", "part"]).drop("_cell", "_log", "_own", "_start")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, tables: Workspace | None = None) -> None:
    """Write ``docs`` with all its columns as one folder per shard and part below ``path``.

    Rows are numbered in a saved table and shards are joined back on the number,
    so rows that share a doc_id (null included) may fill any number of parts. The
    folders are named by the column ``shard``; if ``docs`` has one of its own, by
    ``shard_``, or with as many more underscores as it takes.
    """
    name = "shard"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    tables = tables or Workspace(docs.sparkSession, "shard")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = tables.save(docs.select(row.alias("_row"), F.monotonically_increasing_id().alias("_at")))
    ids = numbered.select(F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text"), "_at")
    shards = _assigned(ids, limit, tables, "_at").select("_at", "shard")
    placed = numbered.join(shards, "_at").select("_row.*", F.col("shard").alias(name))
    placed.repartition(name).write.mode("overwrite").partitionBy(name).parquet(path)
