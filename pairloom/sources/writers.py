"""Writers: appended queues, replaced partitions, score tables, sidecars, indexes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import inverted
from ..plans.recall import FIELDS
from ..plans.retriever import Retriever
from . import storage, versions

# What a manifest of plain files says when all of them count.
EVERY_FILE = {"hide": None, "retire": []}
REPORT_LAYOUT = ["report", "product_segment", "company_code", "load_date"]


@dataclass(frozen=True)
class Written:
    """What a write did; ``kept_old`` means there was nothing to write."""

    rows: int
    kept_old: bool = False


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows while they are written, so nothing is computed or cached twice."""
    observation = Observation("pairloom_write")
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def append_by_position(df: DataFrame, table: str) -> Written:
    """Append to a table whose columns correspond by position, whatever their names."""
    counted, observation = _observed(df)
    counted.write.insertInto(table, overwrite=False)
    return Written(observation.get["rows"])


def append_files(df: DataFrame, path: str, by: Sequence[str] = ()) -> Written:
    counted, observation = _observed(df)
    counted.write.mode("append").partitionBy(*by).parquet(path)
    return Written(observation.get["rows"])


def replace_partitions(
    df: DataFrame, path: str, by: Sequence[str], rows_per_file: int | None = None, **constants: str
) -> Written:
    """Replace exactly the partitions that occur in ``df``; snappy Parquet.

    ``constants`` become (partition) columns. Spark stages the files and swaps
    them in when the job commits: a failed job changes nothing, a run without
    rows leaves the old data in place, and sibling partitions are not touched.
    Rows are gathered by the varying partition columns to avoid many small
    files; Spark splits a partition that is large.
    """
    rows = df.withColumns({name: F.lit(value) for name, value in constants.items()}) if constants else df
    varying = [name for name in by if name not in constants]
    if varying:
        rows = rows.hint("rebalance", *varying)
    counted, observation = _observed(rows)
    writer = (
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(*by).parquet(path)
    written = observation.get["rows"]
    return Written(written, kept_old=written == 0)


def write_report(df: DataFrame, path: str, report: str, segment: str, company: str, load_date: str) -> Written:
    return replace_partitions(
        df, path, REPORT_LAYOUT, report=report, product_segment=segment, company_code=company, load_date=load_date
    )


def write_scores(df: DataFrame, path: str, rows_per_file: int | None = None) -> Written:
    """Overwrite a folder with score rows; ``*_embedding`` columns are dropped."""
    slim = df.drop(*[c for c in df.columns if c.endswith("_embedding")])
    counted, observation = _observed(slim)
    counted.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file or 0).parquet(path)
    return Written(observation.get["rows"])


def write_json(df: DataFrame, path: str) -> None:
    """Small report as one JSON file in a folder."""
    df.repartition(1).write.mode("overwrite").json(path)


def write_competitors(
    spark: SparkSession, folder: str, tenant: str, competitors: Sequence[str], run_date: str, prev_date: str | None = None
) -> None:
    """Sidecar that says which competitors a mapping run covered."""
    names = sorted(competitors)
    row = [(tenant, run_date, prev_date, names, len(names))]
    ddl = "tenant string, run_date string, prev_date string, competitors array<string>, competitor_count int"
    write_json(spark.createDataFrame(row, ddl), f"{folder.rstrip('/')}/competitor_list.json")


def verify_write(table: DataFrame, queue_name: str, load_date: str) -> DataFrame:
    """One row: ``success``, or ``warning`` when nothing of this queue and day is there."""
    count = F.count(F.lit(1))
    return table.where((F.col("queue_name") == queue_name) & (F.col("load_date") == load_date)).agg(
        F.when(count > 0, "success").otherwise("warning").alias("status"), count.alias("rows")
    )


def verify_path(spark: SparkSession, path: str, queue_name: str, load_date: str) -> DataFrame:
    """``verify_write`` for files; ``failure`` when they cannot be read."""
    if not storage.has_data(spark, path):
        return spark.createDataFrame([("failure", None)], "status string, rows bigint")
    return verify_write(spark.read.parquet(path), queue_name, load_date)


def write_recall(
    clean: DataFrame, root: str, marker: str = "comp_source_store=", corrupt: str = "_corrupt", dry_run: bool = False,
    in_place: bool = False, suffix: str = ".csv",
) -> bool:
    """Write de-duplicated recall rows as CSVs with the same header, one folder per partition.

    Rows that carry ``file`` go to that file's folder, sub-folders of the read
    root included; others to the folder their ``part`` names, and rows of no part
    to the root itself. Malformed lines are written as they were. ``in_place``
    means that ``root`` is also the input: the new files replace those that
    `read_recall` took with the same ``marker`` and ``suffix``, and no others
    (`replace_files`). ``dry_run`` writes nothing. Returns whether anything was
    written.
    """
    if dry_run:
        return False
    spark = clean.sparkSession
    header = ",".join(FIELDS)
    line = F.to_csv(F.struct(*FIELDS))
    if corrupt in clean.columns:
        line = F.coalesce(F.col(corrupt), line)
    folder = F.when(F.col("part") == "(root)", F.lit("")).otherwise(F.col("part"))
    if in_place and "file" in clean.columns:
        folder = F.regexp_replace(F.regexp_extract("file", f"^(?:.*?{re.escape(_plain_path(root))}/)(.*)$", 1), "[^/]*$", "")
    rows = clean.select(line.alias(header), F.regexp_replace(folder, "/+$", "").alias("_folder"))
    fresh = f"{root.rstrip('/')}__new"
    # One unquoted column whose name is the header: lines come out verbatim.
    rows.hint("rebalance", "_folder").write.mode("overwrite").partitionBy("_folder").csv(
        fresh, header=True, sep="\u0001", quote="\u0000", escapeQuotes=False,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue="",
    )
    storage.name_folders(spark, fresh, "_folder")
    taken = lambda path: path.endswith(suffix) and (not marker or marker in path)
    replace_files(spark, fresh, root, taken if in_place else lambda path: path.endswith(suffix))
    return True


def replace_files(spark: SparkSession, fresh: str, root: str, outgoing: Callable[[str], bool]) -> None:
    """Put the files below ``fresh`` in the place of those below ``root`` whose path is ``outgoing``.

    Manifests below ``root`` say which files count, so `read_recall` finds either
    all old or all new ones wherever this stops:

    1. Files of this job are hidden while they are moved in, each under its mark.
    2. One manifest uncovers them and retires the old ones: that is the commit.
    3. Retired files are deleted, and a last manifest says that all files count.

    What an earlier job left when it stopped is settled first.
    """
    settle_files(spark, root)
    mark, old = uuid.uuid4().hex, storage.files_below(spark, root, outgoing)
    versions.commit(spark, root, lambda _: {"hide": mark, "retire": []})
    storage.move_in(spark, fresh, root, mark)
    versions.commit(spark, root, lambda _: {"hide": None, "retire": old})
    settle_files(spark, root)
    storage.remove(spark, fresh)


def settle_files(spark: SparkSession, root: str) -> None:
    """Delete the files below ``root`` that its newest manifest hides or retires, and say so."""
    found = versions.newest(spark, root)
    if found is None or found[1] == EVERY_FILE:
        return
    hidden, retired = found[1]["hide"], found[1]["retire"]
    for path in retired + (storage.files_below(spark, root, lambda p: f"/{hidden}-" in p) if hidden else []):
        storage.remove(spark, path)
    versions.commit(spark, root, lambda _: EVERY_FILE)


def _plain_path(path: str) -> str:
    return re.sub(r"^[a-z0-9]+:/+", "/", path.rstrip("/"))


def save_retriever(index: Retriever, path: str) -> int:
    """Vocabulary, inverted lists and rows below ``level=<level>``; a manifest makes all three count at once.

    Returns the version's number. Earlier versions stay readable until their
    folders are removed.
    """
    folder, spark = f"{path.rstrip('/')}/level={index.level}", index.rows.sparkSession
    data = f"data/{uuid.uuid4().hex}"
    index.vocab.write.parquet(f"{folder}/{data}/vocab")
    index.rows.write.parquet(f"{folder}/{data}/rows")
    lists = inverted.copy_index(index.lists, f"{folder}/{data}")
    content = {"data": data, "n_buckets": lists.n_buckets, "n_segments": lists.n_segments, "row_type": lists.row_type}
    return versions.commit(spark, folder, lambda _: content)


def load_retriever(spark: SparkSession, path: str, level: str) -> Retriever:
    """The newest retriever of a level; its lists are read where they are."""
    folder = f"{path.rstrip('/')}/level={level}"
    found = versions.newest(spark, folder)
    if found is None:
        raise FileNotFoundError(f"no retriever under {folder}")
    data = f"{folder}/{found[1]['data']}"
    lists = inverted.InvertedIndex(spark, data, found[1]["n_buckets"], found[1]["row_type"], found[1]["n_segments"])
    return Retriever(spark.read.parquet(f"{data}/vocab"), lists, spark.read.parquet(f"{data}/rows"), level)
