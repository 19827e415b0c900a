"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.session import Workspace


def components(edges: DataFrame, tables: Workspace, first: str = "a", second: str = "b") -> DataFrame:
    """node and component, the smallest node reachable, of every node on an edge.

    Nodes are of any type with an order. Edges with a null end, loops and repeats
    don't count; no edges give no rows. In turn every node points its larger
    neighbours, then its smaller ones, at the smallest neighbour, until nothing
    changes; the rounds grow with the logarithm of the longest path. A round keeps
    no more edges than there were, neighbours are combined by their minimum on
    the map side, and each round is a table in the shared folder.
    """
    def kept(df: DataFrame) -> tuple[DataFrame, tuple]:
        saved = tables.save(df)
        return saved, tuple(saved.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    a, b = F.col(first), F.col(second)
    now, mark = kept(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small_least.select("u", F.col("m").alias("v"))).distinct()
        )
        fresh, fresh_mark = kept(small)
        tables.drop(now)
        now = fresh
        if fresh_mark == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark = fresh_mark
