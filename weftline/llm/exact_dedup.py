"""Exact deduplication as a stream with keyed state that never expires.

The state, on disk in RocksDB and backed up below the shared folder, has one entry per
digest of a normalised text: the digest, the smallest identifier seen with its content
locator (file and row), and the number of rows. A batch is reduced to one row per digest
in every task before it reaches the state, so a text that a third of all rows share is a
few rows there. Every hit is then checked: texts of repeated digests are compared by
their full bytes, and rows that share only the digest are grouped by bytes instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import column, hint_small
from weftline.workspace import exact_path, materialize, new_folder

#: State on disk; files are not allocated ahead, as that takes megabytes for each of many small stores.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

#: Input a micro-batch takes at most, so the size of a batch does not grow with the backlog.
BATCH_BYTES = 64 << 30


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_of(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _located(rows: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(digest, locator): who and where each row is. File rows are unique, so no two locators are equal."""
    return rows.select(
        digest_of(column(text)).alias("digest"),
        F.struct(
            column(doc_id).isNull().alias("no_id"), column(doc_id).cast("bigint").alias("doc_id"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        ).alias("locator"),
    )


def first_seen(
    spark: SparkSession, path: str, *, doc_id: str = "doc_id", text: str = "text", state: str | None = None,
    batch_bytes: int = BATCH_BYTES, files_per_batch: int | None = None,
) -> DataFrame:
    """(digest, keep, group_size) of all Parquet rows at ``path``, by a stream over its files.

    ``state`` is the folder of checkpoint and results; a later call with the same folder
    takes up the files added since, with all earlier digests known. A new one is made
    below the shared folder if none is given.
    """
    folder = state or new_folder(spark, "first-seen")
    results = f"{folder}/results"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes)
    if files_per_batch:
        reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    updates = _located(reader.parquet(exact_path(path)), doc_id, text).groupBy("digest").agg(
        F.min("locator").alias("keep"), F.count(F.lit(1)).alias("group_size")
    )

    def store(batch: DataFrame, number: int) -> None:
        # A batch that is run again after a failure overwrites its own results.
        batch.write.mode("overwrite").parquet(f"{results}/batch={number}")

    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (
            updates.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    told = spark.read.schema(
        "digest string, keep struct<no_id: boolean, doc_id: bigint, file: string, row: bigint>, group_size bigint, batch bigint"
    ).option("basePath", results).parquet(results)
    # The last update of a digest is its state; digests of one batch only need no more than a combine.
    return told.groupBy("digest").agg(
        F.max_by(F.struct("keep", "group_size"), "batch").alias("last")
    ).select("digest", "last.keep", "last.group_size")


def deduplicate(
    spark: SparkSession, path: str, *, doc_id: str = "doc_id", text: str = "text", **stream: object
) -> DataFrame:
    """Every Parquet row at ``path``: its id, the id that stays, group size, whether it stays, and its digest.

    Texts are equal when identical after every run of ASCII white space became one space;
    null counts as empty, so null and empty texts are one group. Of equal texts the row
    with the smallest id stays; a null id counts as larger than any other, and of rows
    with equal ids the first by file and position stays, so exactly one row of each group
    is kept. Other columns are not read. A table without rows gives no rows.
    """
    rows = spark.read.parquet(path)
    if not rows.limit(1).count():
        return spark.createDataFrame([], "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string")
    seen = materialize(first_seen(spark, path, doc_id=doc_id, text=text, **stream), "seen")
    members = _located(rows, doc_id, text)
    groups = members.join(seen, "digest")
    different = _different_bytes(rows, seen, text)
    if different.limit(1).count():
        groups = _by_bytes(rows, different, groups, doc_id, text)
    return groups.select(
        F.col("locator.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("keep_id"),
        F.col("group_size").cast("bigint").alias("group_size"), (F.col("locator") == F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _different_bytes(rows: DataFrame, seen: DataFrame, text: str) -> DataFrame:
    """(digest): groups whose texts are not all the same bytes.

    Every task reduces the texts of repeated digests to distinct ones before any of them
    is shuffled, so a large group of copies is one text per task.
    """
    repeated = hint_small(materialize(seen.where("group_size > 1").select("digest"), "repeated"), 96)
    texts = rows.select(digest_of(column(text)).alias("digest"), normalised(column(text)).cast("binary").alias("bytes"))
    distinct = texts.join(repeated, "digest", "left_semi").distinct()
    return distinct.groupBy("digest").count().where("count > 1").select("digest")


def _by_bytes(rows: DataFrame, different: DataFrame, groups: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``groups`` with the groups in ``different`` formed anew from whole texts instead of digests."""
    different = materialize(different, "different")
    texts = rows.select(
        digest_of(column(text)).alias("digest"), normalised(column(text)).alias("plain"),
        F.struct(
            column(doc_id).isNull().alias("no_id"), column(doc_id).cast("bigint").alias("doc_id"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        ).alias("locator"),
    ).join(different, "digest", "left_semi")
    formed = texts.groupBy("digest", "plain").agg(F.min("locator").alias("keep"), F.count(F.lit(1)).alias("group_size"))
    anew = texts.join(formed, ["digest", "plain"]).select("digest", "locator", "keep", "group_size")
    return groups.join(different, "digest", "left_anti").select("digest", "locator", "keep", "group_size").union(anew)
