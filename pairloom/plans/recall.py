"""De-duplicating recall suggestions after bringing product ids to one form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import canonical_uuid

FIELDS = ["base_sku_uuid", "comp_sku_uuid", "score"]


def dedupe_recall(rows: DataFrame, by_file: bool = True, corrupt: str = "_corrupt") -> DataFrame:
    """Canonical ids, exact (base, comp, score text) repeats dropped.

    The score is compared as text, so ``0.9`` and ``0.90`` both stay. Repeats
    are dropped per (part, file), or over everything with ``by_file=False``.
    Rows with a value in ``corrupt`` had the wrong number of fields and are
    passed through untouched. Duplicates are combined map-side, so a file or
    pair with very many copies is small before it is shuffled.
    """
    scope = [c for c in ("part", "file") if by_file and c in rows.columns]
    has_corrupt = corrupt in rows.columns
    good = rows.where(F.col(corrupt).isNull()).drop(corrupt) if has_corrupt else rows
    tidy = good.withColumns({c: canonical_uuid(F.col(c)) for c in FIELDS[:2]})
    clean = tidy.dropDuplicates([*scope, *FIELDS])
    if not has_corrupt:
        return clean
    return clean.unionByName(rows.where(F.col(corrupt).isNotNull()), allowMissingColumns=True)


def recall_stats(rows: DataFrame, corrupt: str = "_corrupt") -> DataFrame:
    """Per (part, file): rows in and out, removed, malformed and the share removed.

    One aggregation: rows are first counted per distinct triple.
    """
    bad = F.col(corrupt).isNotNull() if corrupt in rows.columns else F.lit(False)
    triples = (
        rows.withColumns({c: canonical_uuid(F.col(c)) for c in FIELDS[:2]} | {"_bad": bad})
        .groupBy("part", "file", *FIELDS, "_bad")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kept = F.when(F.col("_bad"), F.col("n")).otherwise(F.lit(1))
    per_file = triples.groupBy("part", "file").agg(
        F.sum("n").alias("rows_in"),
        F.sum(kept).alias("rows_out"),
        F.sum(F.when(F.col("_bad"), F.col("n")).otherwise(0)).alias("malformed"),
    )
    removed = F.col("rows_in") - F.col("rows_out")
    return per_file.select(
        "part", "file", "rows_in", "rows_out", removed.alias("removed"), "malformed",
        F.round(F.coalesce(F.try_divide(removed * 100.0, F.col("rows_in")), F.lit(0.0)), 1).alias("percent"),
    )


def recall_summary(stats: DataFrame) -> DataFrame:
    """Per partition: files and row totals."""
    return stats.groupBy("part").agg(
        F.count(F.lit(1)).alias("files"),
        *[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "removed", "malformed")],
    )
