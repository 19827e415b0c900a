"""Many sources under one key: a tagged union, folded by one aggregate."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Aggregate = Callable[[Column], Column]


@dataclass(frozen=True)
class Source:
    """Rows of one source under the fold's key columns, and what is kept of them per key.

    ``take``: the columns of one row, the first by ``order`` (ascending) and then by
    these columns themselves, nulls last. ``totals``: output column -> (aggregate,
    column). With ``version`` only rows of the newest version count; it is the
    greatest of all rows of the source, also of those that ``when`` keeps from being
    taken. Rows with a null key give nothing, unless ``null_keys`` lets each set of
    keys be a group of its own.
    """

    name: str
    rows: DataFrame
    take: Sequence[str] = ()
    order: Sequence[Column] = ()
    totals: dict[str, tuple[Aggregate, str]] = field(default_factory=dict)
    version: Column | None = None
    when: Column | None = None
    null_keys: bool = False

    @property
    def picked(self) -> str:
        return f"_{self.name}"

    @property
    def seen(self) -> str:
        return f"_{self.name}_version"


def descending(text: Column) -> Column:
    """A text whose ascending order is the descending one of ``text``.

    The complement of its bytes in hexadecimal; the end mark puts a text after
    those that go on where it ends.
    """
    return F.concat(F.translate(F.hex(F.encode(text, "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def fold(keys: Sequence[str], sources: Sequence[Source]) -> DataFrame:
    """One row per key of any source: the keys, and for each source its first row as a struct and its totals.

    Every source is read once and all of them are shuffled together, cut to one row
    per key and task before that, however many rows a key has. Save the result
    before `taken` is applied to it, since the newest version is a total of it.
    """
    parts, aggregates = [], []
    every_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    for s in sources:
        columns, whole = {}, F.lit(True) if s.null_keys else every_key
        if s.take:
            version = [descending(s.version).alias("_down"), s.version.alias("_is")] if s.version is not None else []
            order = [o.alias(f"_o{i}") for i, o in enumerate(s.order)]
            fields = [f for c in s.take for f in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c).alias(c))]
            row = F.struct(*version, *order, *fields)
            counts = [c for c in (whole, s.when, None if s.version is None else s.version.isNotNull()) if c is not None]
            columns[s.picked] = F.when(reduce(lambda a, b: a & b, counts), row)
            aggregates.append(F.min(s.picked).alias(s.picked))
        for name, (how, column) in s.totals.items():
            columns[name] = F.when(whole, F.col(column))
            aggregates.append(how(F.col(name)).alias(name))
        if s.version is not None:
            columns[s.seen] = s.version
            aggregates.append(F.max(s.seen).alias(s.seen))
        rows = s.rows if s.version is not None else s.rows.where(whole)
        parts.append(rows.select(*keys, *[c.alias(n) for n, c in columns.items()]))
    names = [c for p in parts for c in p.columns if c not in keys]
    types = {f.name: f.dataType for p in parts for f in p.schema.fields}
    aligned = [
        p.select(*keys, *[F.col(n) if n in p.columns else F.lit(None).cast(types[n]).alias(n) for n in names]) for p in parts
    ]
    return reduce(DataFrame.union, aligned).groupBy(*keys).agg(*aggregates)


def newest_row(folded: DataFrame, source: Source) -> Column:
    """The row that ``source`` gives to each key of a saved result of `fold`, as a struct; null where it has none."""
    row = F.col(source.picked)
    if source.version is None:
        return row
    return F.when(row["_is"] == folded.select(F.max(source.seen)).scalar(), row)


def taken(folded: DataFrame, source: Source) -> dict[str, Column]:
    """The columns that ``source`` gives to each key of a saved result of `fold`; null where it has no row."""
    row = newest_row(folded, source)
    return {c: row[c] for c in source.take} | {n: F.col(n) for n in source.totals}
