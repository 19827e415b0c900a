"""Session helpers: recommended settings and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_SHIPPED: set[str] = set()

# Whole texts, or rows as large, that a Python worker is sent at a time.
ROWS_PER_BATCH = 1_024

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "pairloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the plans expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor must reach.

    Only a session whose executors are threads of this process (``local`` or
    ``local[n]``) gets a folder of its own when none is set; any other must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = _LOCAL.get(spark.sparkContext.applicationId) or tempfile.mkdtemp(prefix="pairloom-")
        _LOCAL[spark.sparkContext.applicationId] = folder
    return folder.rstrip("/")


class Workspace:
    """Tables of one run in the shared folder, dropped by the caller when no longer read.

    A frame returned by an operator may still read some of them, so they are
    dropped after its action: ``with Workspace(spark) as tables: ...`` or ``drop()``.
    """

    def __init__(self, spark: SparkSession, label: str = "run"):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/pairloom-{label}-{uuid.uuid4().hex}"
        self._count = 0

    def save(self, df: DataFrame, *by: str) -> DataFrame:
        """``df`` computed once and read back: a lost executor costs a re-read."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}"
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        saved = self.spark.read.schema(df.schema).parquet(path)
        saved._pairloom_path = path
        return saved

    def drop(self, *frames: DataFrame) -> None:
        """Delete the tables behind ``frames`` (made by ``save``), or all of them."""
        for path in [f._pairloom_path for f in frames] or [self.root]:
            handle = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            handle.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(handle, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()


def cut_lineage(df: DataFrame, tables: Workspace | None = None) -> DataFrame:
    """``df`` computed once and read back from a Parquet table in the shared folder.

    Losing an executor afterwards costs a re-read and not a recomputation, and
    readers prune columns and know the size. ``tables`` names the workspace that
    drops the table later; without one it stays until that folder is cleared.
    """
    return (tables or Workspace(df.sparkSession)).save(df)


def bound_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Send at most ``rows`` rows at a time to Python workers from now on; a smaller setting stays.

    Spark's 10,000 rows of whole texts or of their sets are held several times over
    at once: as Arrow buffers outside the heap of each executor, as what the worker
    reads and as what it makes. No result depends on where batches end.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    For checkouts that are neither installed on the workers nor given with
    ``--py-files``; Spark itself distributes the archive.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        source = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="pairloom-")) / "pairloom.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(source.rglob("*.py")):
                out.write(file, file.relative_to(source.parent).as_posix())
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
