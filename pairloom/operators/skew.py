"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .relational import first_row, null_safe

SALT = "_salt"
# Hash values per part by which keys are counted first.
BUCKETS = 16


@dataclass(frozen=True)
class HotKeys:
    """Keys that are too frequent for one task, with the number of parts each is cut into.

    ``frame`` is a local table of the key columns and ``_salts`` with fewer rows
    than there are shuffle partitions, None if no key is hot.
    """

    keys: list[str]
    frame: DataFrame | None


def hot_key_sets(
    df: DataFrame, sets: Sequence[Sequence[str]], parts: int | None = None, weight: str | None = None
) -> list[HotKeys]:
    """For each set of key columns, the keys (null included) with more rows than a task's even share.

    The share is the number of rows over ``parts``, by default the number of
    shuffle partitions, so a key is hot at any size of the data if it is too much
    for one task, and fewer than ``parts`` keys are. A key with n rows is cut
    into n / share parts. ``weight`` names a column saying how many rows each row
    of ``df`` stands for.

    All sets are counted in one pass when this is called, by a hash of the key with
    ``BUCKETS`` values per part, so tasks shuffle as many counts however many keys
    there are. A bucket with no more rows than the share holds no hot key; only
    keys of the other buckets are counted themselves, and only the most frequent
    ones, fewer than ``parts`` for each set, come to the driver.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = list(dict.fromkeys(c for s in sets for c in s))
    rows = df.select(*names, *([weight] if weight else []))
    buckets = {
        f"_bucket{i}": F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(BUCKETS * parts)).cast("int")
        for i, keys in enumerate(sets)
    }
    # The total comes first; the buckets of all sets that are above the share are among the next ones.
    counted = rows.select(*[c.alias(n) for n, c in buckets.items()], *([weight] if weight else []))
    most, total = _most_frequent(counted, [[n] for n in buckets], parts, weight)
    full = [[r[n] for r in some] for n, some in zip(buckets, most, strict=True)]
    asked = [i for i, some in enumerate(full) if some]
    exact: dict[int, list] = {}
    if asked:
        within = reduce(or_, [buckets[f"_bucket{i}"].isin(full[i]) for i in asked])
        exact = dict(zip(asked, _most_frequent(rows.where(within), [sets[i] for i in asked], parts, weight, total)[0], strict=True))
    share = max(1, total // parts)
    found = []
    for i, keys in enumerate(sets):
        hot = [(*[r[c] for c in keys], -(-r["_n"] // share)) for r in exact.get(i, [])]
        schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in keys] + [T.StructField("_salts", T.IntegerType())])
        found.append(HotKeys(list(keys), spark.createDataFrame(hot, schema) if hot else None))
    return found


def _most_frequent(
    rows: DataFrame, sets: Sequence[Sequence[str]], parts: int, weight: str | None, total: int | None = None
) -> tuple[list[list[Row]], int]:
    """For each set of columns its values with more than ``total / parts`` rows (``_n``), and ``total``, by default that of ``rows``."""
    names = list(dict.fromkeys(c for s in sets for c in s))
    size = F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1))
    counted = rows.groupingSets([[F.col(c) for c in s] for s in [*sets, []]], *names).agg(
        size.alias("_n"), F.grouping_id().alias("_set")
    )
    found = counted.orderBy(F.desc("_n"), F.desc("_set")).limit(parts * len(sets) + 1).collect()
    if total is None:
        total = found[0]["_n"] if found else 0
    marks = [int("".join("0" if c in keys else "1" for c in names), 2) for keys in sets]
    return [[r for r in found if r["_set"] == mark and r["_n"] * parts > total] for mark in marks], total


def hot_keys(df: DataFrame, keys: Sequence[str], parts: int | None = None, weight: str | None = None) -> HotKeys:
    """``hot_key_sets`` for one set of key columns."""
    return hot_key_sets(df, [keys], parts, weight)[0]


def _flagged(df: DataFrame, hot: HotKeys) -> DataFrame:
    marks = hot.frame.select(*[F.col(k).alias(f"_hot_{k}") for k in hot.keys], "_salts")
    match = [df[k].eqNullSafe(marks[f"_hot_{k}"]) for k in hot.keys]
    # Fewer rows than shuffle partitions, see hot_key_sets.
    return df.join(F.broadcast(marks), reduce(and_, match), "left").drop(*[f"_hot_{k}" for k in hot.keys])


def salt_many(df: DataFrame, hot: HotKeys, salt_from: Sequence[str] | None = None) -> DataFrame:
    """The big side: rows of hot keys get one of their key's salts, the others 0.

    The salt is a hash of ``salt_from`` (all columns by default) and not random,
    so a recomputed task sends each row where it went before.
    """
    source = [F.col(f"`{c}`") for c in (salt_from or df.columns)]
    salt = F.coalesce(F.pmod(F.xxhash64(*source), F.col("_salts")).cast("int"), F.lit(0))
    return _flagged(df, hot).withColumn(SALT, salt).drop("_salts")


def salt_copies(df: DataFrame, hot: HotKeys) -> DataFrame:
    """The other side: rows of hot keys once per salt of their key, the others with salt 0."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    return _flagged(df, hot).withColumn(SALT, F.explode(salts)).drop("_salts")


def attach_all(
    left: DataFrame, sides: Sequence[tuple[DataFrame, Sequence[str], Sequence[Column]]], hot: HotKeys | None,
    salt_from: Sequence[str] | None = None, how: str = "left",
) -> DataFrame:
    """Left (or inner) joins to the first row per key of each ``(right, on, order)``.

    Never more rows than ``left``. Each side is cut to one row per key before
    anything is copied. Frequent keys (``hot``, from ``hot_keys`` on some or all
    of the join columns) are spread: ``left`` is salted once, so neighbouring
    sides with the same join columns need only one shuffle of it. Without hot
    keys choosing the first row and joining share one shuffle of each side.
    """
    if hot is None or hot.frame is None:
        for right, on, order in sides:
            left = left.join(first_row(right, on, order), list(on), how)
        return left
    rows = salt_many(left, hot, salt_from)
    for right, on, order in sides:
        rows = rows.join(salt_copies(first_row(right, on, order), hot), [*on, SALT], how)
    return rows.drop(SALT)


def attach_first(
    left: DataFrame, right: DataFrame, on: Sequence[str], hot: HotKeys | None = None,
    order: Sequence[Column] = (), salt_from: Sequence[str] | None = None,
) -> DataFrame:
    """``attach_all`` for one side; without ``hot`` an ordinary left join."""
    return attach_all(left, [(right, on, order)], hot, salt_from)


def join_spread(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, hot: HotKeys,
    salt_from: Sequence[str] | None = None,
) -> DataFrame:
    """Inner, left, semi or anti join with the hot keys of ``left`` spread out."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    if hot.frame is None:
        return left.join(right, list(on), how)
    return salt_many(left, hot, salt_from).join(salt_copies(right, hot), [*on, SALT], how).drop(SALT)


def anti_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner, where null keys match each other."""
    known = right.select(*[F.col(k).alias(f"_r_{k}") for k in on]).distinct()
    return left.join(known, null_safe(on), "left_anti")
