"""Row picking, snapshots, scopes: the relational building blocks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> list[Column]:
    """``order`` followed by every remaining column, ascending with nulls last."""
    rest = [
        F.col(f"`{f.name}`").asc_nulls_last()
        for f in df.schema.fields
        if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return [*order, *rest]


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, ties settled by all other columns.

    Spark keeps only the first row per key on the map side already, so a key
    that holds a large share of the rows is cut down before it is shuffled.
    """
    window = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return df.withColumn("_nth", F.row_number().over(window)).where("_nth = 1").drop("_nth")


def latest_row(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    return first_row(df, keys, [F.col(version).desc_nulls_last()])


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per key with their position in ``rank``."""
    window = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Every row with its position in ``rank``; the sort spills and streams."""
    window = Window.partitionBy(*keys).orderBy(*total_order(df, keys, order))
    return df.withColumn("rank", F.row_number().over(window))


def latest_snapshot(
    df: DataFrame, version: str, scope: Column | None = None, override: str | None = None
) -> DataFrame:
    """Rows of the newest ``version`` (or of ``override``).

    The maximum is taken over the rows in ``scope`` and enters as a scalar
    subquery, which prunes partitions when ``version`` is a partition column.
    """
    if override is not None:
        return df.where(F.col(version) == F.lit(override))
    scoped = df if scope is None else df.where(scope)
    return df.where(F.col(version) == scoped.select(F.max(version)).scalar())


def latest_partition(
    df: DataFrame, parts: Sequence[str] = ("year", "month", "day"), scope: Column | None = None,
    override: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of the newest composite partition; one equality per part keeps pruning alive."""
    if override is not None:
        return df.where(_all(F.col(p) == F.lit(v) for p, v in zip(parts, override, strict=True)))
    scoped = df if scope is None else df.where(scope)
    newest = scoped.select(F.max_by(F.struct(*parts), F.concat(*parts)).alias("p"))
    return df.where(_all(F.col(p) == newest.select(f"p.{p}").scalar() for p in parts))


def latest_value(df: DataFrame, column: str) -> DataFrame:
    """Newest value of a partition column as a one-row frame; reads no data columns."""
    return df.agg(F.max(column).alias(column))


def required_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which each of ``columns`` is neither null nor empty."""
    if not columns:
        return df
    return df.where(_all(F.coalesce(F.col(c) != "", F.lit(False)) for c in columns))


def optional_filter(df: DataFrame, predicate: Column | str | None) -> DataFrame:
    """Caller-supplied predicate, or everything when there is none."""
    if predicate is None or (isinstance(predicate, str) and not predicate.strip()):
        return df
    return df.where(predicate)


def column_or(df: DataFrame, name: str, default: str) -> Column:
    """The column if the frame has it, else a constant; always text."""
    return F.col(name).cast("string") if name in df.columns else F.lit(default)


def live(df: DataFrame) -> DataFrame:
    """Active rows that are not soft-deleted."""
    return df.where(F.col("active") & F.col("deleted_date").isNull())


def stores_in_scope(pairs: DataFrame, registered: DataFrame, column: str = "comp_source_store") -> DataFrame:
    """Registered stores that occur in ``pairs``; all registered ones if none does."""
    every = registered.select(column).distinct()
    used = every.join(pairs.select(column).distinct(), column, "left_semi")
    none_used = used.select(F.count(F.lit(1))).scalar() == 0
    return used.unionByName(every.where(none_used))


def competitor_stores(domains: DataFrame, tenant: str, override: Sequence[str] | None = None) -> DataFrame:
    """Distinct ``comp_source_store`` registered for a tenant; ``override`` wins."""
    if override is not None:
        names = sorted({s.strip() for s in override if s.strip()})
        if not names:
            raise ValueError("the competitor override is empty")
        return domains.sparkSession.createDataFrame([(n,) for n in names], "comp_source_store string")
    return domains.where(F.col("client") == tenant).select(F.col("primary").alias("comp_source_store")).distinct()


def is_short(df: DataFrame, most: int = 10_000) -> bool:
    """Whether ``df`` has at most ``most`` rows; counts no further."""
    return df.limit(most + 1).count() <= most


def short_list(df: DataFrame, most: int = 10_000) -> DataFrame:
    """``df`` marked for broadcast if it is known to have at most ``most`` rows, else as it is."""
    return F.broadcast(df) if is_short(df, most) else df


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """``df`` unchanged, or ``ValueError`` when it has no row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def unknown_stores(drop: DataFrame, registered: DataFrame) -> DataFrame:
    """Stores that occur in a drop but are not registered."""
    from ..functions.keys import store_underscore

    store = F.lower(store_underscore(F.trim(F.col("comp_source_store"))))
    seen = drop.select(store.alias("comp_source_store")).where(F.col("comp_source_store") != "").distinct()
    return seen.join(registered.select("comp_source_store"), "comp_source_store", "left_anti")


def null_safe(keys: Sequence[str], prefix: str = "_r_") -> Column:
    """Join condition in which null equals null; the other side's keys carry ``prefix``."""
    return _all(F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys)


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)
