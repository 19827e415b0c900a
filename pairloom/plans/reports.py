"""Small reports about examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOW_COUNT = 3


def label_distribution(examples: DataFrame, labels: Sequence[str], label: str = "match_norm") -> DataFrame:
    """(label, count, percent, low) with a row for every valid label."""
    spark = examples.sparkSession
    valid = spark.createDataFrame([(name,) for name in labels], f"{label} string")
    counts = examples.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    total = counts.select(F.sum("count")).scalar()
    filled = F.coalesce("count", F.lit(0))
    return valid.join(counts, label, "left").select(
        F.col(label),
        filled.alias("count"),
        F.round(F.coalesce(F.try_divide(filled * 100.0, total), F.lit(0.0)), 1).alias("percent"),
        (filled < LOW_COUNT).alias("low"),
    )


def brand_counts(examples: DataFrame, brand: str = "base_brand") -> DataFrame:
    """(brand, count), most frequent first; a missing brand is ``unknown``."""
    named = F.coalesce(F.col(brand), F.lit("unknown")).alias("brand")
    return examples.groupBy(named).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), "brand")


def example_metrics(own: DataFrame, synthetic: DataFrame | None = None) -> DataFrame:
    """(source, brand, count, total) for own and synthetic examples together."""
    def part(df: DataFrame, source: str) -> DataFrame:
        return brand_counts(df).select(F.lit(source).alias("source"), "brand", "count")

    rows = part(own, "own_data")
    if synthetic is not None:
        rows = rows.unionByName(part(synthetic, "synth_data"))
    totals = rows.groupBy("source").agg(F.sum("count").alias("total"))
    return rows.join(totals, "source")
