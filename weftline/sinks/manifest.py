"""Datasets whose current files are named by a manifest, and compaction of their small files only.

A dataset is a folder of Parquet files, partitioned or not. Its manifests lie in
``_manifests/<version>``, one row per current file; without one all files are current. A
compaction writes its new files below ``_generations/<version>``, where plain listings
do not see them, and then publishes the next manifest by one rename: readers see either
all of the old files or all of the new ones. Files that are large enough are not read,
and stay where and as they are.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weftline.sources.files import list_files
from weftline.workspace import Storage, materialize, new_folder

#: Files of one partition that are packed together; a partition with more is cut into slices by a hash of the name.
PACKED_FILES = 50_000
#: Files above this share of the target size are left alone.
LARGE_SHARE = 0.75

_ENTRY = "base string, path string, length bigint"


def versions(spark: SparkSession, location: str) -> list[int]:
    folder = f"{location}/_manifests"
    storage = Storage(spark)
    return sorted(int(n) for n in storage.names_in(folder) if n.isdigit()) if storage.exists(folder) else []


def current_files(spark: SparkSession, location: str) -> DataFrame:
    """(base, path, length) of the dataset's current files; ``base`` is the folder above their partition folders."""
    known = versions(spark, location)
    if known:
        return spark.read.schema(_ENTRY).parquet(f"{location}/_manifests/{known[-1]:08d}")
    files = list_files(spark, location).where(F.col("name").endswith(".parquet"))
    return files.select(F.lit(location).alias("base"), "path", "length")


def read_current(spark: SparkSession, location: str, schema: StructType) -> DataFrame:
    """The rows of the current files."""
    known = versions(spark, location)
    if not known:
        return spark.read.schema(schema).parquet(location)
    by_base: dict[str, list[str]] = {}
    for row in current_files(spark, location).toLocalIterator():
        by_base.setdefault(row["base"], []).append(row["path"])
    out = None
    for base, paths in sorted(by_base.items()):
        part = spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _packed(target: int):
    """First fit by falling size: each bin's lengths add up to the target at most."""

    def pack(files: pd.DataFrame) -> pd.DataFrame:
        files = files.sort_values(["length", "path"], ascending=[False, True])
        loads: list[int] = []
        open_bins: list[int] = []
        numbers = []
        for length in files["length"]:
            at = next((b for b in open_bins if loads[b] + length <= target), None)
            if at is None:
                at = len(loads)
                loads.append(0)
                open_bins = [*open_bins[-63:], at]  # a bounded number of bins is kept open
            loads[at] += length
            numbers.append(at)
        return files.assign(bin=numbers)[["base", "path", "length", "folder", "slice", "bin"]]

    return pack


def small_file_bins(files: DataFrame, file_bytes: int, large_share: float = LARGE_SHARE) -> DataFrame:
    """(path, bin): the files to be rewritten, and with which others of their partition; bins of one file are left out."""
    # The partition a file belongs to, whichever generation wrote it.
    own = F.filter(F.split("path", "/"), lambda part: part.contains("=") & ~part.startswith("weftline_bin="))
    small = files.where(F.col("length") < large_share * file_bytes).withColumn("folder", F.array_join(own, "/"))
    counts = small.groupBy("folder").agg(F.ceil(F.count(F.lit(1)) / PACKED_FILES).alias("slices"))
    sliced = small.join(counts, "folder").withColumn("slice", F.pmod(F.xxhash64("path"), "slices")).drop("slices")
    bins = sliced.groupBy("folder", "slice").applyInPandas(
        _packed(file_bytes), f"{_ENTRY}, folder string, slice bigint, bin bigint"
    )
    name = F.sha1(F.concat_ws("|", "folder", "slice", "bin"))
    several = materialize(bins.withColumn("bin", name), "bins")
    again = several.groupBy("bin").agg(F.count(F.lit(1)).alias("files")).where("files > 1").select("bin")
    return several.join(again, "bin").select("base", "path", "length", "bin")


def compact_small(
    spark: SparkSession, location: str, partition_by: list[str], schema: StructType, file_bytes: int = 256 << 20,
    large_share: float = LARGE_SHARE,
) -> int:
    """Merge the small files of each partition folder into files of up to ``file_bytes``; returns how many were merged.

    Every bin is one task's work and becomes one file. Nothing is deleted: files that are
    no longer current can be removed once no reader uses an older manifest. Of two
    compactions at a time, one fails when it publishes.
    """
    files = materialize(current_files(spark, location), "current")
    bins = materialize(small_file_bins(files, file_bytes, large_share), "small-files")
    merged = bins.count()
    if not merged:
        return 0
    version = (versions(spark, location) or [0])[-1] + 1
    base = f"{location}/_generations/{version:08d}-{new_folder(spark, 'g').rpartition('-')[2]}"
    rows = _read_bins(spark, bins, schema)
    (
        rows.repartition(max(1, bins.select("bin").distinct().count()), "weftline_bin")
        .write.partitionBy(*partition_by, "weftline_bin").parquet(base)
    )
    written = list_files(spark, base).where(F.col("name").endswith(".parquet")).select(F.lit(base).alias("base"), "path", "length")
    left = files.join(bins.select("path"), "path", "left_anti").select("base", "path", "length")
    staged = new_folder(spark, "manifest")
    left.unionByName(written).write.parquet(staged)
    Storage(spark).publish(staged, f"{location}/_manifests/{version:08d}")
    return merged


def _read_bins(spark: SparkSession, bins: DataFrame, schema: StructType) -> DataFrame:
    """Rows of the files in ``bins`` with the bin they go to."""
    by_base: dict[str, list[str]] = {}
    for row in bins.select("base", "path").toLocalIterator():
        by_base.setdefault(row["base"], []).append(row["path"])
    named = bins.select(_plain("path").alias("_path"), F.col("bin").alias("weftline_bin"))
    out = None
    for base, paths in sorted(by_base.items()):
        read = spark.read.schema(schema).option("basePath", base).parquet(*paths)
        part = read.select(*schema.names, _plain("_metadata.file_path").alias("_path"))
        out = part if out is None else out.unionByName(part)
    return out.join(named, "_path").drop("_path")


def _plain(path: str):
    """A path without the slashes that differ between ways to write ``file:`` locations."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
