"""Loading only what is new: a ledger of files, and batches that are committed as a whole.

Below ``location``, ``batches/batch=<n>`` holds the rows of one load and, beside them, the
ledger of the files they came from. A batch is written elsewhere first and moved into
place by one rename, so rows and ledger appear together or not at all: a load that breaks
before leaves nothing that is read, and the next one takes its files again; a load that
is repeated finds its files in the ledger. Each row is written once: rejected rows lie in
a folder of their own within the batch, and values that found no place beside their row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.conform import INVALID, LEFT_OUT, Contract, complete
from weftline.sinks.table import OPEN_PARTITIONS
from weftline.sources.files import list_files, read_conformed
from weftline.workspace import Storage, materialize, new_folder, open_partitions

LOADED = "_loaded"
_LEDGER = "path string, category string, length bigint, modificationTime timestamp"


def batch_numbers(spark: SparkSession, location: str) -> list[int]:
    folder, storage = f"{location}/batches", Storage(spark)
    return sorted(int(n.partition("=")[2]) for n in storage.names_in(folder)) if storage.exists(folder) else []


def ledger(spark: SparkSession, location: str) -> DataFrame:
    """(path, category, length, modificationTime, batch) of every file loaded so far."""
    if not batch_numbers(spark, location):
        return spark.createDataFrame([], f"{_LEDGER}, batch int")
    base = f"{location}/batches"
    return spark.read.schema(f"{_LEDGER}, batch int").option("basePath", base).parquet(f"{base}/*/kind=files").drop("kind")


def new_files(spark: SparkSession, root: str, location: str) -> DataFrame:
    """Files below ``root`` that no batch has."""
    listed = list_files(spark, root).where("length > 0").select("path", "category", "length", "modificationTime")
    return listed.join(ledger(spark, location).select("path"), "path", "left_anti")


def changed_files(spark: SparkSession, root: str, location: str) -> DataFrame:
    """Files that were loaded and have another length or time now. They are not loaded again, as that would double rows."""
    listed = list_files(spark, root).select("path", F.col("length").alias("now_length"), F.col("modificationTime").alias("now_time"))
    differs = (F.col("length") != F.col("now_length")) | (F.col("modificationTime") != F.col("now_time"))
    return ledger(spark, location).join(listed, "path").where(differs).select("path", "batch", "length", "now_length")


def load_new(
    spark: SparkSession, root: str, location: str, contract: Contract, kind: str = "parquet", category: str = "taxi_type",
    before_commit: Callable[[], None] | None = None,
) -> dict[str, int] | None:
    """Load the files that are new as one batch; None if there are none. Returns the batch's number and counts.

    ``before_commit`` runs when all is written and nothing is published. Of two loads at a
    time, one fails when it commits and can be repeated.
    """
    files = materialize(new_files(spark, root, location), "new-files")
    if files.isEmpty():
        return None
    number = (batch_numbers(spark, location) or [0])[-1] + 1
    staged = new_folder(spark, "staged-batch")
    seen = Observation()
    rows = read_conformed(spark, root, contract, kind, category, files.select("path", "category"))
    watched = rows.withColumn(LOADED, complete(contract)).observe(
        seen, F.count(F.lit(1)).alias("source"), F.count_if(LOADED).alias("loaded"), F.count_if(~F.col(LOADED)).alias("rejected"),
        F.count_if(F.size(LEFT_OUT) > 0).alias("with_values_left_out"),
    )
    with open_partitions(spark, OPEN_PARTITIONS):
        watched.write.partitionBy(LOADED, *contract.partition_by).parquet(f"{staged}/kind=rows")
    files.coalesce(1 + files.count() // 100_000).write.parquet(f"{staged}/kind=files")
    if before_commit:
        before_commit()
    Storage(spark).publish(staged, f"{location}/batches/batch={number}")
    return {"batch": number, "files": files.count(), **seen.get}


def _all_rows(spark: SparkSession, location: str, contract: Contract) -> DataFrame:
    extra = [
        T.StructField(INVALID, T.StringType()), T.StructField(LEFT_OUT, T.MapType(T.StringType(), T.StringType())),
        T.StructField(LOADED, T.BooleanType()), T.StructField("batch", T.IntegerType()),
    ]
    # A rejected row may lack a value in any column.
    fields = [T.StructField(f.name, f.dataType) for f in contract.schema.fields]
    schema = T.StructType([*fields, *extra])
    if not batch_numbers(spark, location):
        return spark.createDataFrame([], schema)
    base = f"{location}/batches"
    return spark.read.schema(schema).option("basePath", base).parquet(f"{base}/*/kind=rows").drop("kind")


def loaded_rows(spark: SparkSession, location: str, contract: Contract) -> DataFrame:
    """The contract's columns of all rows loaded by any batch."""
    rows = _all_rows(spark, location, contract)
    return rows.where(F.col(LOADED)).select(*[f.name for f in contract.schema.fields])


def rows_aside(spark: SparkSession, location: str, contract: Contract) -> DataFrame:
    """Rejected rows, and loaded ones with values that found no place, with the batch they came in."""
    return _all_rows(spark, location, contract).where(~F.col(LOADED) | (F.size(LEFT_OUT) > 0))
