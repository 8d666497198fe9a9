"""Session helpers: the shared folder, written intermediates and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side of a join is broadcast only when it is known to hold at most this many rows.
BROADCAST_ROWS = 500_000

# Files a task holds open at once while it writes partitions; rows of further ones are sorted first.
OPEN_FILES = 64
_OPEN_FILES_KEY = "spark.sql.maxConcurrentOutputFileWriters"
_FREE_SHUFFLES_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting (a test) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tripmart-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/tripmart/{name}-{uuid.uuid4().hex}"


class Kept(NamedTuple):
    """A frame on a written table, with (a bound of) its row count and the table's path."""

    df: DataFrame
    rows: int
    path: str


def keep(df: DataFrame, name: str, path: str | None = None) -> Kept:
    """Write ``df`` as Parquet and read it back, counting the rows during the write.

    Cuts the lineage in a way that survives lost executors, and fixes the result of
    non-deterministic steps (sampled range bounds) for every later reader.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    written = Observation()
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .parquet(path)
    )
    return Kept(spark.read.schema(df.schema).parquet(path), written.get["rows"], path)


@contextmanager
def open_files(spark: SparkSession, n: int = OPEN_FILES) -> Iterator[None]:
    """Partitioned writes in here put each row into its partition's open file.

    Else a task first sorts all of its rows by partition, and so holds or spills its whole input.
    For writes of few partitions a task. Threads that write are started and joined in here.
    """
    before = spark.conf.get(_OPEN_FILES_KEY, None)
    spark.conf.set(_OPEN_FILES_KEY, n)
    try:
        yield
    finally:
        spark.conf.set(_OPEN_FILES_KEY, before) if before else spark.conf.unset(_OPEN_FILES_KEY)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs in here delete their shuffle files as they end.

    Else the files stay until the driver happens to collect its garbage. Not for threads that
    begin before or end after.
    """
    before = spark.conf.get(_FREE_SHUFFLES_KEY)
    spark.conf.set(_FREE_SHUFFLES_KEY, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES_KEY, before)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], Kept]]:
    """A ``keep`` for tables that are read in here only; they are deleted at the end."""
    paths = []

    def keep_here(df: DataFrame, name: str) -> Kept:
        paths.append(new_path(spark, name))
        return keep(df, name, paths[-1])

    try:
        yield keep_here
    finally:
        for path in paths:
            remove_path(spark, path)


def small_side(kept: Kept, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if its counted size allows one, else unhinted.

    Unhinted, Spark joins it by shuffle and AQE splits skewed keys.
    """
    return F.broadcast(kept.df) if kept.rows <= limit else kept.df


def _located(spark: SparkSession, path: str):
    """A path and its store, any that Spark reaches."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; whether there was one."""
    place, store = _located(spark, path)
    return store.delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    place, store = _located(spark, path)
    return store.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted; none if there is no such folder."""
    place, store = _located(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def file_states(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, time and length of a file, or of the files in a folder; asks the store, runs no job."""
    place, store = _located(spark, path)
    status = store.getFileStatus(place)
    found = store.listStatus(place) if status.isDirectory() else [status]
    return sorted((s.getPath().toString(), s.getModificationTime(), s.getLen()) for s in found)


def release(spark: SparkSession) -> bool:
    """Delete all that this session's jobs have kept below the shared folder.

    For the end of a run that has a shared folder of its own: frames that read kept tables cannot
    be used afterwards.
    """
    return remove_path(spark, f"{shared_dir(spark)}/tripmart")
