"""Shared working folders and Hadoop file-system calls.

Intermediate tables must be readable by every executor, so they go below
``spark.checkpoint.dir``. Where that is unset they go below the warehouse, if that is a
shared store or all runs on one machine; never into a machine's own temporary folder.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

#: Rows that one task writes of a table of which no more than a known number are expected.
ROWS_A_TASK = 50_000

_run_folders: dict[str, str] = {}
_scopes: list[set[str]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach.

    On several machines a warehouse on the driver's own disk is not one, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir")
        scheme = urlsplit(configured).scheme
        if scheme in ("", "file") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return configured.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """This run's own folder below the shared root; removed again when Python ends."""
    app = spark.sparkContext.applicationId
    if app not in _run_folders:
        _run_folders[app] = f"{shared_root(spark)}/weftline-{uuid.uuid4().hex}"
        atexit.register(_remove_quietly, Storage(spark), _run_folders[app])
    return _run_folders[app]


def _remove_quietly(storage: Storage, folder: str) -> None:
    try:
        storage.remove(folder)
    except Exception:  # noqa: BLE001 - the JVM may already be gone
        pass


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the run's folder that nothing else uses; nothing is created yet."""
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.add(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A block whose intermediate tables are removed when it ends well.

    Yields a function that writes a table to be kept: what the block returns must come
    from there, not from tables that go.
    """
    mine: set[str] = set()
    kept: set[str] = set()

    def keep(df: DataFrame, label: str) -> DataFrame:
        before = set(mine)
        out = materialize(df, label)
        kept.update(mine - before)
        return out

    _scopes.append(mine)
    try:
        yield keep
    finally:
        _scopes.remove(mine)
    for path in mine - kept:
        Storage(spark).remove(path)


def exact_path(path: str) -> str:
    """A pattern that only ``path`` itself matches, be it a file or a folder; streams take single files as patterns only."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def materialize(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives executor loss.

    ``rows`` is about how many narrow rows it has at most. They are then written by as few tasks
    as that takes, since on a local disk every file makes the executor start processes of its own.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_TASK)))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept in memory or on local disks for the block, and released after it in any case."""
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def batch_bytes(spark: SparkSession, most: int):
    """Python tasks that start in the block are handed batches of about ``most`` bytes; one row at least."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def open_partitions(spark: SparkSession, most: int):
    """Tasks that write partitioned files in the block keep up to ``most`` of them open at a time.

    Up to that number rows go out as they come; without it each task first sorts all of its rows by partition.
    """
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most))


class Storage:
    """The few Hadoop ``FileSystem`` calls the sinks need, for any configured scheme."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, location: str):
        path = self._path(location)
        return path.getFileSystem(self._conf), path

    def exists(self, location: str) -> bool:
        fs, path = self._at(location)
        return fs.exists(path)

    def bytes_under(self, location: str) -> int:
        fs, path = self._at(location)
        return fs.getContentSummary(path).getLength()

    def names_in(self, location: str) -> list[str]:
        """Entry names of one directory (not recursive)."""
        fs, path = self._at(location)
        return sorted(status.getPath().getName() for status in fs.listStatus(path))

    def move(self, source: str, target: str) -> None:
        fs, src = self._at(source)
        dst = self._path(target)
        parent = dst.getParent()
        if parent is not None:
            fs.mkdirs(parent)
        if not fs.rename(src, dst):
            raise OSError(f"could not move {source} to {target}")

    def publish(self, source: str, target: str) -> None:
        """Move a finished folder to ``target`` in one step, or fail if that exists."""
        fs, src = self._at(source)
        dst = self._path(target)
        fs.mkdirs(dst.getParent())
        gateway, hadoop = self._gateway, self._jvm.org.apache.hadoop.fs
        options = gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        hadoop.FileContext.getFileContext(fs.getUri(), self._conf).rename(fs.makeQualified(src), fs.makeQualified(dst), options)

    def remove(self, location: str) -> None:
        fs, path = self._at(location)
        fs.delete(path, True)
