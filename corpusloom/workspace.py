"""The shared folder for tables that several later steps read.

Lineage is cut only through tables written here, so a lost executor costs a
re-read and never the result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
# Rows that a task writes at least, where their number is known: on local disks Hadoop starts processes for every file.
ROWS_A_FILE = 1 << 16
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Paths of the tables of each open ``passing_tables``, the innermost last.
_PASSING: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder named by the session; only a local session may fall back to its own."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="corpusloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and continue from the files.

    The files stay for as long as results built on them are in use; emptying the
    folder afterwards is up to its owner. ``rows`` is about how many there are, if known:
    a table of few rows is then not written in as many files as the session shuffles to.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if rows is not None:
        df = df.coalesce(max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_A_FILE)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what runs inside go as soon as it ends, not when the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`settle` writes inside are deleted at the end, but those it was told to keep."""
    _PASSING.append([])
    try:
        yield
    finally:
        for path in _PASSING.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def settle(df: DataFrame, name: str, keep: int = 0) -> DataFrame:
    """:func:`materialize` for a table of the input's size between two shuffles.

    It is packed harder, and the shuffle files that made it are gone when it is written.
    It outlives ``keep`` of the open :func:`passing_tables`; where no more are open, it is up to the folder's owner.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    scope = len(_PASSING) - 1 - keep
    if scope >= 0:
        _PASSING[scope].append(path)
    with shuffles_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
