"""Numbers, dates and small value rules."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def price_number(text: Column) -> Column:
    """Double for plain numeric text; ``nan``, blanks and anything else give null.

    The pattern keeps out spellings only some engines accept, such as ``1.0d``.
    """
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def price_gate(base_price: Column, comp_price: Column, ratio: float, strict: bool = False) -> Column:
    """True when the prices differ by less than ``ratio`` of the base price.

    A base price that is missing or zero, or any unparsable price, fails. A
    negative base price fails too unless ``strict``, where the ratio is simply
    negative and hence passes.
    """
    base, comp = price_number(base_price), price_number(comp_price)
    usable = (base != 0) if strict else (base > 0)
    return F.coalesce(usable & (F.try_divide(F.abs(base - comp), base) < F.lit(float(ratio))), F.lit(False))


def fallback(*choices: Column) -> Column:
    """First choice that is neither null nor empty; the last one is taken as is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices[:-1]], choices[-1])


def present(value: Column) -> Column:
    return value.isNotNull()


def truthy(value: Column) -> Column:
    """Boolean with null read as false."""
    return F.coalesce(value, F.lit(False))


def composite_date(year: Column, month: Column, day: Column) -> Column:
    return F.concat(year, month, day)


def split_iso_date(text: str) -> tuple[str, str, str]:
    """Validated ``YYYY-MM-DD`` as its three text parts."""
    datetime.date.fromisoformat(text)
    year, month, day = text.split("-")
    return year, month, day


def is_iso_date(text: Column) -> Column:
    return text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")


def epoch_day(date: Column, plus_days: int = 0) -> Column:
    """Epoch seconds of midnight UTC, ``plus_days`` later."""
    return (F.unix_date(F.date_add(F.to_date(date), plus_days)) * 86400).cast("int")


def hash_index(key: Column, low: int = 10000, size: int = 90000) -> Column:
    """Repeatable stand-in for a random index: the same key keeps its index on a retry."""
    digits = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")
    return (digits % size + low).cast("int")


def random_index(low: int = 10000, size: int = 90000, seed: int | None = None) -> Column:
    return (F.floor(F.rand(seed) * size) + low).cast("int")


def combined_score(embedding: Column, tfidf: Column, weights: Sequence[float] = (0.7, 0.3)) -> Column:
    return F.round(F.lit(weights[0]) * embedding + F.lit(weights[1]) * tfidf, 4)


def json_field(text: Column, path: str) -> Column:
    return F.get_json_object(text, path)


def dot(left: Column, right: Column) -> Column:
    """Dot product of two numeric arrays; null if either is null."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
