"""File listings, lineage, expected-file checks and reading of drifting file sets."""

from __future__ import annotations

import json
import math
import os
import stat
from collections.abc import Iterator
from datetime import UTC, datetime
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.conform import Contract, conform, drift_report
from weftline.workspace import materialize


_LISTED = "path string, length bigint, modificationTime timestamp"
#: Folders that one task lists in a round.
FOLDERS_PER_TASK = 1_000
#: Entries of a folder that a task holds at a time.
ENTRIES_AT_ONCE = 10_000


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` as rows; contents are never read.

    Folders are listed level by level: the tasks of a round list one folder at a time, each
    without what lies below it, and the folders they find are dealt out anew for the next
    round. So one deep or wide folder does not become one task. The driver sees only the
    number of folders per round. Names that start with "." or "_" are left out, as in
    Spark's own listings.
    """
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    base = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base).toString()
    frontier, rounds = spark.createDataFrame([(base,)], "folder string"), []
    while True:
        listed = materialize(frontier.mapInPandas(_list_level, _LISTED), "listed")
        rounds.append(listed.where("length >= 0"))
        folders = listed.where("length < 0").select(F.col("path").alias("folder"))
        found = folders.count()
        if not found:
            break
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil(found / FOLDERS_PER_TASK))
        frontier = folders.repartition(tasks, "folder")
    return reduce(DataFrame.unionByName, rounds).select(
        "path", parent_name(F.col("path")).alias("category"), file_name(F.col("path")).alias("name"), "length", "modificationTime"
    )


def _entries(folder: str) -> Iterator[tuple[str, int, datetime]]:
    """(name, length, time) of a folder's entries; folders have a negative length.

    A disk is read entry by entry. Other stores have no such call in Arrow, and give the
    folder's list as a whole.
    """
    from pyarrow.fs import FileSelector, FileType, LocalFileSystem

    store, inner = open_store(folder)
    if isinstance(store, LocalFileSystem):
        with os.scandir(inner) as found:
            for entry in found:
                try:
                    status = entry.stat()
                except FileNotFoundError:  # it went meanwhile, or is a link to nothing
                    continue
                yield entry.name, -1 if stat.S_ISDIR(status.st_mode) else status.st_size, datetime.fromtimestamp(status.st_mtime_ns / 1e9, UTC)
        return
    for entry in store.get_file_info(FileSelector(inner)):
        yield entry.path[len(inner):].lstrip("/"), entry.size if entry.type == FileType.File else -1, entry.mtime


def _list_level(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The entries of each folder, some at a time; folders among them have a negative length."""
    for batch in batches:
        for folder in batch["folder"]:
            shown = (e for e in _entries(folder) if e[0][:1] not in ("", ".", "_"))
            while rows := [(f"{folder.rstrip('/')}/{name}", length, time) for name, length, time in islice(shown, ENTRIES_AT_ONCE)]:
                yield pd.DataFrame(rows, columns=["path", "length", "modificationTime"])


def parent_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def missing_months(spans: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Months of each ``(key, first_month, last_month)`` span that ``present`` lacks.

    ``present`` holds ``(key, month)`` with months as ``yyyy-MM``.
    """
    first = F.to_date(F.concat("first_month", F.lit("-01")))
    last = F.to_date(F.concat("last_month", F.lit("-01")))
    expected = spans.select(
        key, F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("start")
    ).select(key, F.date_format("start", "yyyy-MM").alias("month"))
    # Existing rows shrink to one per key and month before they are shuffled.
    return expected.join(present.select(key, "month").distinct(), [key, "month"], "left_anti")


def open_store(path: str):
    """The Arrow file system of ``path`` and the path inside it; usable inside tasks."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _parquet_signature(path: str) -> str:
    import pyarrow.parquet as pq

    store, inner = open_store(path)
    schema = pq.read_schema(inner, filesystem=store)
    return json.dumps([[f.name, str(f.type)] for f in schema])


def _csv_signature(path: str) -> str:
    import csv
    import io

    store, inner = open_store(path)
    with store.open_input_stream(inner) as raw:
        line = next(io.TextIOWrapper(raw, encoding="utf-8-sig"), "")
    return json.dumps(next(csv.reader([line.rstrip("\r\n")]), []))


_SIGNATURES = {"parquet": _parquet_signature, "csv": _csv_signature}


def file_signatures(
    spark: SparkSession, root: str, kind: str, tasks: int | None = None, only: DataFrame | None = None
) -> DataFrame:
    """``(path, category, signature)`` per file, or of the files ``only``: footers or header lines are read by the executors."""
    signature = _SIGNATURES[kind]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(signature=[signature(p) for p in batch["path"]])

    files = list_files(spark, root).where("length > 0").select("path", "category") if only is None else only
    spread = files.repartition(tasks or spark.sparkContext.defaultParallelism)
    return spread.mapInPandas(read, "path string, category string, signature string")


#: Paths of one scan of a folder that mixes schemas.
SCAN_PATHS = 10_000


def schema_groups(
    spark: SparkSession, root: str, kind: str, only: DataFrame | None = None
) -> list[tuple[str, str, list[str]]]:
    """Scans that together cover all files: ``(signature, one of its files, paths to scan)``.

    Files are reduced to distinct (folder, schema) before anything reaches the driver. A
    folder of one schema is scanned as a whole; only where a folder mixes schemas are its
    files named, in scans of bounded length, as they are where ``only`` some are wanted.
    """
    files = materialize(
        file_signatures(spark, root, kind, only=only).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1)), "signatures"
    )
    found = files.groupBy("folder", "signature").agg(F.min("path").alias("example"))
    found = found.withColumn("kinds", F.count(F.lit(1)).over(Window.partitionBy("folder"))).collect()
    scans: list[tuple[str, str, list[str]]] = []
    whole: dict[str, tuple[str, list[str]]] = {}
    for row in sorted(found, key=lambda r: (r["signature"], r["folder"])):
        if row["kinds"] == 1 and only is None:
            whole.setdefault(row["signature"], (row["example"], []))[1].append(row["folder"])
            continue
        named = files.where((F.col("folder") == row["folder"]) & (F.col("signature") == row["signature"])).select("path")
        paths: list[str] = []
        for one in named.toLocalIterator():
            paths.append(one["path"])
            if len(paths) == SCAN_PATHS:
                scans.append((row["signature"], row["example"], paths))
                paths = []
        if paths:
            scans.append((row["signature"], row["example"], paths))
    return [(signature, example, paths) for signature, (example, paths) in sorted(whole.items())] + scans


def _read_group(spark: SparkSession, kind: str, signature: str, example: str, paths: list[str]) -> DataFrame:
    if kind == "parquet":
        return spark.read.schema(spark.read.parquet(example).schema).parquet(*paths)
    fields = [T.StructField(name, T.StringType()) for name in json.loads(signature)]
    return spark.read.option("header", True).option("escape", '"').schema(T.StructType(fields)).csv(paths)


def read_conformed(
    spark: SparkSession, root: str, contract: Contract, kind: str = "parquet", category: str = "taxi_type",
    only: DataFrame | None = None,
) -> DataFrame:
    """Every file below ``root/<category>/``, or those ``only`` (path, category), in the contract's schema, as one plan.

    One scan per distinct schema, not per file. The category is the parent folder's name.
    """
    path = F.col("_metadata.file_path")
    parts = [
        conform(_read_group(spark, kind, *group), contract, {"filename": path, category: parent_name(path)})
        for group in schema_groups(spark, root, kind, only)
    ]
    if not parts:
        raise ValueError(f"no {kind} files below {root}")
    return reduce(DataFrame.unionByName, parts)


def read_drift_report(spark: SparkSession, root: str, contract: Contract, kind: str = "parquet") -> DataFrame:
    """The drift report of each scan, labelled with its folder names."""
    reports = []
    for signature, example, paths in schema_groups(spark, root, kind):
        folders = {p if p.rpartition(".")[2] != kind else p.rpartition("/")[0] for p in paths}
        feed = ",".join(sorted({folder.rpartition("/")[2] for folder in folders}))
        reports.append(drift_report(_read_group(spark, kind, signature, example, paths), feed, contract))
    return reduce(DataFrame.unionByName, reports)
