"""Small helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
# Bits of the filter that `maybe_in` broadcasts: 8 MB whatever the data.
FILTER_BITS = 1 << 26
# A key is hot when it holds more than 1/HOT_PARTS of the rows: fewer than HOT_PARTS keys.
HOT_PARTS = 1024
# Hash bits by which a histogram is refined per round.
BITS_PER_ROUND = 12


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bits60(text: Column) -> Column:
    """The first 60 bits of the hexadecimal digest ``text`` as a long."""
    return F.conv(F.substring(text, 1, 15), 16, 10).cast("long")


def maybe_in(df: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """``df`` with ``flag``: false only if the non-negative long ``key`` is not in ``keys``.

    A bit map of ``FILTER_BITS`` bits is broadcast, so its size never depends on
    the data; a row of another key may also get true, so an exact join follows.
    Null keys get false. A column of ``df`` named like the helpers is an error.
    """
    spot = lambda c: F.pmod(F.col(c), F.lit(FILTER_BITS)) + 1  # noqa: E731  bit maps number from 1
    bits = (
        keys.where(F.col(key).isNotNull())
        .groupBy(F.bitmap_bucket_number(spot(key)).alias("_map"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot(key))).alias("_bits"))
    )
    # Longs are read where they lie; of a binary value each row would copy the whole map.
    longs = F.transform(F.sequence(F.lit(0), F.lit(511)), lambda i: F.conv(F.hex(F.substring("_bits", 8 * i + 1, F.lit(8))), 16, -10).cast("long"))
    found = df.withColumn("_map", F.bitmap_bucket_number(spot(key))).join(F.broadcast(bits.select("_map", longs.alias("_bits"))), "_map", "left")
    place = F.bitmap_bit_position(spot(key)).cast("int")
    # The first of eight bytes is the highest of its long.
    at = 56 - 8 * (F.floor(place / 8).cast("int") % 8) + place % 8
    hit = F.when(F.col("_bits").isNotNull(), F.getbit(F.get("_bits", F.floor(place / 64).cast("int")), at) == 1)
    return found.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_map", "_bits")


def attach(df: DataFrame, groups: DataFrame, key: str, size: str, total: int, hot_parts: int = HOT_PARTS) -> DataFrame:
    """Left join of ``groups`` (one row per ``key``) with the hot keys kept out of the shuffle.

    ``size`` says how many of ``total`` rows of ``df`` a group stands for. Groups
    above ``total / hot_parts`` are fewer than ``hot_parts``, which bounds what is
    broadcast; the rows they settle, and null keys, are spread over the other join.
    """
    names = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) * hot_parts > total)
    rest = groups.where(F.col(size) * hot_parts <= total).withColumn("_spread", F.lit(0))
    first = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    apart = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(1 << 20)).cast("int") + 1
    spread = F.when(F.col("_hot") | F.col(key).isNull(), apart).otherwise(0)
    second = first.withColumn("_spread", spread).join(
        rest.select(key, "_spread", *[F.col(c).alias(f"_rest_{c}") for c in names]), [key, "_spread"], "left"
    )
    return second.select(
        *df.columns, *[F.coalesce(F.col(c), F.col(f"_rest_{c}")).alias(c) for c in names]
    )


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Only the columns an operator reads, so extra columns can't clash with its own."""
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"columns {missing} are missing")
    return df.select(*names)


def without_rows(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose long ``key`` is in ``dropped``; other texts aren't shuffled."""
    gone = dropped.select(F.col(key).alias("_key")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(key).alias("_key"))
    flagged = maybe_in(rows, "_key", gone, "_maybe")
    other = flagged.where(~F.col("_maybe")).select("_row")
    return other.unionByName(flagged.where("_maybe").join(gone, "_key", "left_anti").select("_row")).select("_row.*")
