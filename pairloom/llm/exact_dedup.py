"""Exact dedup through an extendible-hash index on shared files, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.common import attach, bits60, maybe_in, require_columns
from pairloom.llm.extendible import split_buckets
from pairloom.session import Workspace

CAPACITY = 4096


def exact_groups(
    docs: DataFrame, tables: Workspace | None = None, capacity: int = CAPACITY, key_bits: int = 60
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, bucket_depth, bucket, link.

    Texts are equal when their bytes are; null counts as the empty text, so null
    and empty texts form one group. The row with the largest doc_id stays; rows
    that repeat that doc_id and text are kept together, and a group without any
    doc_id keeps its rows without one. ``link`` is the place of the row's text in
    the chain of its key, from 1. Other columns are not read. Without rows the
    result is empty. ``key_bits`` below 60 only makes collisions likelier, for tests.

    1. Each text gets a key, the first bits of its digest. The keys form the
       directory: buckets of ``capacity`` keys, split bit by bit (`split_buckets`).
    2. Texts whose key comes more than once go to the owner of its key range,
       copies of a task as one. The owner compares the bytes of the texts of a key
       and chains the different ones; each link has its size and the doc_id that
       stays (`_chains`).
    3. The links, and the keys that come once, are the index, written in key ranges
       to the shared folder; every row takes its group from there.
    """
    docs = require_columns(docs, ["doc_id", "text"])
    tables = tables or Workspace(docs.sparkSession, "exact")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    cut = 60 - key_bits
    key = F.shiftleft(F.shiftright(bits60(F.col("text_sha256")), cut), cut)

    prints = tables.save(docs.select("doc_id", digest.alias("text_sha256")).withColumn("key", key))
    total = max(1, prints.count())
    rows_of = prints.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("only_id"))
    entries = tables.save(rows_of.withColumn("weight", F.lit(1).cast("long")))
    directory = tables.save(split_buckets(entries, capacity, tables).select(
        "key", "n", "only_id", F.col("depth").alias("bucket_depth"), F.col("prefix").alias("bucket")
    ))

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    texts = maybe_in(texts.withColumn("key", key), "key", directory.where("n > 1"), "_maybe").where("_maybe")
    chains = tables.save(_chains(texts.select("doc_id", "key", "text")))
    once = directory.where("n = 1").select(
        "key", "bucket_depth", "bucket", F.lit(1).alias("link"), F.lit(1).alias("links"), F.lit(None).cast("string").alias("text_sha256"),
        F.lit(1).cast("long").alias("group_size"), F.col("only_id").alias("keep_id"),
    )
    linked = directory.where("n > 1").select("key", "bucket_depth", "bucket").join(chains.hint("merge"), "key").select(once.columns)
    index = tables.save(once.unionByName(linked).repartitionByRange("key").sortWithinPartitions("key", "link"))

    given = ["keep_id", "group_size", "bucket_depth", "bucket", "link"]
    # A key with one link settles its rows; the others look for their text's link.
    found = attach(prints, index.where("links = 1").drop("text_sha256", "links"), "key", "group_size", total)
    if not index.where("links > 1").isEmpty():
        several = index.where("links > 1").select("text_sha256", *[F.col(c).alias(f"_own_{c}") for c in given])
        found = attach(found, several, "text_sha256", "_own_group_size", total)
        found = found.withColumns({c: F.when(F.col("_own_link").isNull(), F.col(c)).otherwise(F.col(f"_own_{c}")) for c in given})
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        "bucket_depth", "bucket", "link",
    )


def _chains(texts: DataFrame) -> DataFrame:
    """key, link, links, text_sha256, group_size, keep_id: the different texts of each key, compared byte by byte.

    ``texts`` has doc_id, key and text. Equal texts of one task are combined before
    anything is shuffled, so a text with a third of the rows is one row per task.
    Keys are then dealt out by range, and grouping and numbering the texts of a key
    needs no more than its owner.
    """
    task = F.spark_partition_id().alias("_task")
    partial = texts.groupBy(task, "key", "text").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep"))
    owned = partial.repartitionByRange("key").sortWithinPartitions("key", "text")
    members = owned.groupBy("key", "text").agg(F.sum("n").alias("group_size"), F.max("keep").alias("keep_id"))
    chain = Window.partitionBy("key")
    return members.select(
        "key", F.row_number().over(chain.orderBy("text")).alias("link"), F.count(F.lit(1)).over(chain).cast("int").alias("links"),
        F.sha2("text", 256).alias("text_sha256"), "group_size", "keep_id",
    )


def drop_copies(docs: DataFrame, tables: Workspace | None = None) -> DataFrame:
    """``docs`` with all its columns, without the rows of equal texts that do not stay.

    Exactly one row of each text stays, whatever the doc_ids: where several rows of a
    text share its largest doc_id (or have none), one of them. Null is the empty text.
    Only rows whose digest repeats are shuffled; the others stay where they are.
    """
    tables = tables or Workspace(docs.sparkSession, "exact")
    found = tables.save(exact_groups(docs, tables).where(F.col("group_size") > 1).select("text_sha256").distinct())
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"),
        F.sha2(text, 256).alias("_digest"),
    ).withColumn("_key", bits60(F.col("_digest")))
    keys = found.select(bits60(F.col("text_sha256")).alias("_key"))
    flagged = maybe_in(rows, "_key", keys, "_maybe")
    other = flagged.where(~F.col("_maybe")).select("_row")
    # One row per digest on the map side first, so a text with a third of the rows is one row per task.
    again = flagged.where("_maybe").groupBy("_digest").agg(F.max_by("_row", F.struct(F.col("_id").isNotNull(), "_id")).alias("_row"))
    return other.unionByName(again.select("_row")).select("_row.*")
