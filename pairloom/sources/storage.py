"""The few file-system questions that Spark's readers do not answer."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark._jsc.hadoopConfiguration())


def has_data(spark: SparkSession, path: str) -> bool:
    """True if ``path`` is a file, or a folder with any file below it."""
    handle, fs = _path(spark, path)
    if not fs.exists(handle):
        return False
    return not fs.getFileStatus(handle).isDirectory() or fs.listFiles(handle, True).hasNext()


def first_data_file(spark: SparkSession, folder: str) -> str | None:
    """First non-empty file by name whose name starts with neither ``_`` nor ``.``."""
    handle, fs = _path(spark, folder)
    if not fs.exists(handle):
        return None
    first, files = None, fs.listFiles(handle, True)
    while files.hasNext():
        status = files.next()
        if status.getLen() > 0 and not status.getPath().getName().startswith(("_", ".")):
            name = status.getPath().toString()
            first = name if first is None else min(first, name)
    return first


def partition_values(spark: SparkSession, path: str, column: str) -> Iterator[str]:
    """Values of the folders ``column=<value>`` right below ``path``; the default partition is left out."""
    handle, fs = _path(spark, path)
    listed = fs.listStatusIterator(handle)
    while listed.hasNext():
        name, sign, value = listed.next().getPath().getName().partition("=")
        if sign and name == column and value != "__HIVE_DEFAULT_PARTITION__":
            yield unquote(value)


def file_size(spark: SparkSession, path: str) -> int:
    handle, fs = _path(spark, path)
    return fs.getFileStatus(handle).getLen()


def name_folders(spark: SparkSession, root: str, column: str) -> None:
    """Rename the folders ``column=<escaped value>`` below ``root`` to the paths that the values are."""
    top, fs = _path(spark, root)
    for status in fs.listStatus(top):
        head, sign, value = status.getPath().getName().partition(f"{column}=")
        if head or not sign:
            continue
        place = "" if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value)
        files = fs.listFiles(status.getPath(), False)
        while files.hasNext():
            file = files.next().getPath()
            target = _path(spark, "/".join(filter(None, [root.rstrip("/"), place, file.getName()])))[0]
            fs.mkdirs(target.getParent())
            if not fs.rename(file, target):
                raise OSError(f"cannot move {file.toString()}")
        fs.delete(status.getPath(), True)


def files_below(spark: SparkSession, path: str, wanted: Callable[[str], bool]) -> list[str]:
    """Files below a folder whose path is ``wanted``; folders whose name starts with ``_`` or ``.`` aren't looked into."""
    top, fs = _path(spark, path)
    found, folders = [], [top] if fs.exists(top) else []
    while folders:
        for status in fs.listStatus(folders.pop()):
            place = status.getPath()
            if place.getName().startswith(("_", ".")):
                continue
            if status.isDirectory():
                folders.append(place)
            elif wanted(place.toUri().getPath()):
                found.append(place.toString())
    return sorted(found)


def move_in(spark: SparkSession, fresh: str, target: str, mark: str) -> None:
    """Move the data files below ``fresh`` to the same places below ``target``; ``mark`` is put before each name."""
    new, fs = _path(spark, fresh)
    start = len(fs.makeQualified(new).toString().rstrip("/")) + 1
    moved = fs.listFiles(new, True)
    while moved.hasNext():
        path = moved.next().getPath()
        if path.getName().startswith(("_", ".")):
            continue
        folder = path.getParent().toString()[start:]
        place = _path(spark, "/".join(filter(None, [target.rstrip("/"), folder, f"{mark}-{path.getName()}"])))[0]
        fs.mkdirs(place.getParent())
        if not fs.rename(path, place):
            raise OSError(f"cannot move {path.toString()} to {place.toString()}")


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder; none if it isn't there."""
    handle, fs = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(handle)] if fs.exists(handle) else []


def partition_folders(
    spark: SparkSession, path: str, by: Sequence[str], newest_first: bool = False
) -> Iterator[tuple[str, list[str | None]]]:
    """Each folder ``a=<value>/b=<value>`` below ``path``, with its values; null (the least) for the default partition.

    In the order of the values as text. A folder is listed only when the walk
    comes to it, so who stops early leaves the others unlisted.
    """
    def below(inside: str, values: list[str | None], rest: Sequence[str]) -> Iterator[tuple[str, list[str | None]]]:
        if not rest:
            yield inside, values
            return
        found = []
        for name in names_in(spark, f"{path}/{inside}".rstrip("/")):
            head, sign, value = name.partition("=")
            if sign and head == rest[0]:
                found.append((None if value == "__HIVE_DEFAULT_PARTITION__" else unquote(value), name))
        for value, name in sorted(found, key=lambda f: (f[0] is not None, f[0] or ""), reverse=newest_first):
            yield from below(f"{inside}/{name}".lstrip("/"), [*values, value], rest[1:])

    return below("", [], list(by))


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file, empty if it isn't there."""
    handle, fs = _path(spark, path)
    if not fs.exists(handle):
        return ""
    stream = fs.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False, and nothing changed, if there is one of that name already."""
    handle, fs = _path(spark, path)
    if fs.exists(handle):
        return False
    try:
        stream = fs.create(handle, False)
    except Exception:
        # Another writer was faster.
        if fs.exists(handle):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def remove(spark: SparkSession, path: str) -> None:
    handle, fs = _path(spark, path)
    fs.delete(handle, True)
