"""Extendible hashing as DataFrame steps: buckets split on one more hash bit until they fit."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import Workspace

BITS = 60
# Bits looked at per round beyond the first; the first covers the size of the data.
STEP = 6
FIRST_MOST = 24


def _slot(key, depth: int):
    return F.shiftright(key, BITS - depth)


def split_buckets(entries: DataFrame, capacity: int, tables: Workspace) -> DataFrame:
    """Put every entry into a bucket of at most ``capacity``; columns depth, prefix, load are added.

    ``entries`` has a unique long ``key`` below 2**60 and a long ``weight`` (0 or
    more). A bucket is the set of keys that share their first ``depth`` bits,
    ``prefix``; it is split only while its ``load`` is over ``capacity``. Keys
    whose own weight is too large end at depth 60 with a load over ``capacity``.
    An empty table gives an empty table.

    The directory doubles several times per round: loads are summed per slot of
    the deepest level at once and rolled up, and only entries of slots that are
    still overfull take part in the next round, on deeper bits. So a round costs
    one aggregation of what is left, and the directory never grows for buckets
    that fit.
    """
    total = entries.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    base, depth = 0, min(FIRST_MOST, max(1, math.ceil(math.log2(max(2.0, total / max(1, capacity)))) + 2))
    rest, done = entries, None
    while True:
        slots = rest.groupBy(_slot(F.col("key"), depth).alias("slot")).agg(F.sum("weight").alias("load"))
        level = F.explode(F.sequence(F.lit(base), F.lit(depth)))
        nodes = tables.save(
            slots.select("slot", "load", level.alias("depth"))
            .groupBy("depth", F.expr(f"shiftright(slot, {depth} - depth)").alias("prefix"))
            .agg(F.sum("load").alias("load"))
        )
        parents = nodes.select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_up"), (F.col("load") > capacity).alias("_split")
        )
        leaves = (
            nodes.withColumn("_up", F.shiftright("prefix", 1)).join(parents, ["depth", "_up"], "left")
            .where((F.col("load") <= capacity) | (F.col("depth") == depth))
            .where((F.col("depth") == base) | F.col("_split"))
            .select("depth", "prefix", "load")
        )
        # Directory slots that point to each bucket.
        directory = leaves.withColumn(
            "_slot", F.explode(F.expr(
                f"sequence(shiftleft(prefix, {depth} - depth), shiftleft(prefix + 1, {depth} - depth) - 1)"
            ))
        )
        placed = tables.save(rest.withColumn("_slot", _slot(F.col("key"), depth)).join(directory, "_slot").drop("_slot"))
        final = depth == BITS
        settled = placed if final else placed.where(F.col("load") <= capacity)
        done = settled if done is None else done.unionByName(settled)
        if final:
            return done
        rest = placed.where(F.col("load") > capacity).select(*entries.columns)
        if rest.isEmpty():
            return done
        base, depth = depth, min(BITS, depth + STEP)
