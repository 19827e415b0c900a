"""Versions of a folder: a small numbered manifest says what counts, and writing one is the only commit.

No data file is ever changed, and nothing depends on a rename being atomic, so this
is safe where renames are copies. A reader takes the newest manifest that is whole.
Whatever breaks off before that leaves the version before in force, and some unused
files that ``clean`` or the next writer removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import storage

MANIFESTS = "_versions"


class Conflict(RuntimeError):
    """Others committed versions meanwhile, more often than was tried again."""


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}"


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all manifests of ``path``, finished or not."""
    names = storage.names_in(spark, _folder(path))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def load(spark: SparkSession, path: str, number: int) -> dict | None:
    """What a manifest says, or None if it isn't there or was never finished."""
    try:
        found = json.loads(storage.read_small(spark, f"{_folder(path)}/{number}.json"))
    except ValueError:
        return None
    return found["content"] if isinstance(found, dict) and found.get("whole") else None


def newest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    """Number and content of the newest whole manifest, None before the first."""
    found = ((n, load(spark, path, n)) for n in reversed(numbers(spark, path)))
    return next(((n, c) for n, c in found if c is not None), None)


def commit(spark: SparkSession, path: str, make: Callable[[dict | None], dict], tries: int = 20) -> int:
    """Write the next manifest, which ``make`` derives from the newest one; returns its number.

    If another writer takes the number first, its version is looked at and the next
    number tried.
    """
    for _ in range(tries):
        base, number = newest(spark, path), max(numbers(spark, path), default=0) + 1
        text = json.dumps({"content": make(base[1] if base else None), "whole": True})
        if storage.write_new(spark, f"{_folder(path)}/{number}.json", text):
            return number
    raise Conflict(f"no version of {path} could be committed in {tries} tries")


class VersionedTable:
    """Parquet folders below ``path`` and the manifests that say which of them count.

    A manifest holds the schema and a list of entries, each a folder and, for
    partitioned tables, the values of its partition columns as text. Its size
    follows the number of partitions and appends, not the rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def version(self) -> int | None:
        """The newest version, None before the first."""
        found = newest(self.spark, self.path)
        return found and found[0]

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, by default the newest; None if there is none."""
        if version is None:
            latest = newest(self.spark, self.path)
            found = latest and latest[1]
        else:
            found = load(self.spark, self.path, version)
        if found is None:
            return None
        schema, by = T.StructType.fromJson(found["schema"]), found["by"]
        slim = T.StructType([f for f in schema.fields if f.name not in by])
        # Folders of one set of partition values are read together.
        groups: dict[tuple, list[str]] = {}
        for entry in found["entries"]:
            groups.setdefault(tuple(entry["values"]), []).append(f"{self.path}/{entry['folder']}")
        every = None
        for values, folders in groups.items():
            constants = [F.lit(v).cast(schema[c].dataType).alias(c) for c, v in zip(by, values, strict=True)]
            rows = self.spark.read.schema(slim).parquet(*folders).select("*", *constants).select(*schema.names)
            every = rows if every is None else every.unionByName(rows)
        return self.spark.createDataFrame([], schema) if every is None else every

    def overwrite(self, df: DataFrame) -> int:
        """Make ``df`` the whole table; returns the version."""
        fresh = self._write(df, [])
        return self._commit(df.schema, [], lambda _: fresh)

    def append(self, df: DataFrame) -> int:
        """Add the rows of ``df``, which has the table's columns; returns the version."""
        fresh = self._write(df, [])
        return self._commit(df.schema, [], lambda old: [*old, *fresh])

    def replace_partitions(self, df: DataFrame, by: Sequence[str]) -> int | None:
        """Replace exactly the partitions that occur in ``df``; None, and no new version, without rows."""
        fresh = self._write(df, list(by))
        if not fresh:
            return None
        replaced = {tuple(e["values"]) for e in fresh}
        return self._commit(df.schema, list(by), lambda old: [e for e in old if tuple(e["values"]) not in replaced] + fresh)

    def _write(self, df: DataFrame, by: list[str]) -> list[dict]:
        """Write ``df`` into a new folder; its entries, one per set of partition values."""
        folder = f"data/{uuid.uuid4().hex}"
        rows = df.withColumns({c: F.col(c).cast("string") for c in by}).hint("rebalance", *by) if by else df
        rows.write.partitionBy(*by).option("compression", "snappy").parquet(f"{self.path}/{folder}")
        if not by:
            return [{"folder": folder, "values": []}]
        found = storage.partition_folders(self.spark, f"{self.path}/{folder}", by)
        return [{"folder": f"{folder}/{inside}", "values": values} for inside, values in found]

    def _commit(self, schema: T.StructType, by: list[str], entries: Callable[[list[dict]], list[dict]]) -> int:
        def make(base: dict | None) -> dict:
            if base and base["entries"] and base["by"] != by:
                raise ValueError(f"the table at {self.path} is partitioned by {base['by']}, not by {by}")
            return {"schema": json.loads(schema.json()), "by": by, "entries": entries(base["entries"] if base else [])}

        return commit(self.spark, self.path, make)

    def clean(self, keep: int = 1) -> int:
        """Drop data folders that none of the newest ``keep`` versions names, and older manifests; returns how many.

        Must not run beside a writer, whose folder isn't named by any version yet.
        """
        every = numbers(self.spark, self.path)
        contents = {n: c for n in every if (c := load(self.spark, self.path, n)) is not None}
        kept = sorted(contents)[-keep:]
        named = {e["folder"].split("/")[1] for n in kept for e in contents[n]["entries"]}
        gone = [n for n in storage.names_in(self.spark, f"{self.path}/data") if n not in named]
        for name in gone:
            storage.remove(self.spark, f"{self.path}/data/{name}")
        for number in every:
            if kept and number < kept[0]:
                storage.remove(self.spark, f"{_folder(self.path)}/{number}.json")
        return len(gone)
