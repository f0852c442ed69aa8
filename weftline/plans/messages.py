"""Keyed JSON messages as one batch and as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.strings import keyed_json
from weftline.operators.numbering import number_rows
from weftline.plans.tables import table
from weftline.streaming.commits import qualified, read_committed, start_committed
from weftline.streaming.irregular import irregular_rows
from weftline.streaming.messages import (
    LABELS, MESSAGE_SCHEMA, SALES_DIMENSIONS, file_stream, sales_messages, start_messages,
)
from weftline.streaming.progress import ProgressLog, progress_table, spanned
from weftline.workspace import Storage, materialize, new_folder


def _parsed(messages: DataFrame) -> DataFrame:
    body = F.from_json("value", MESSAGE_SCHEMA).alias("body")
    return messages.select("key", body).select("key", "body.*")


def keyed_json_batch(spark: SparkSession, folder: str) -> DataFrame:
    """One sales message per order: its key picks the combination, its price scales the sale.

    Factors are quarters, so four times a price never falls between two cents.
    """
    orders = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    return _parsed(sales_messages(orders, key, key, F.col("o_totalprice") * 4))


def stream_keyed_json(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as a file stream, sent as messages to a file sink, read back."""
    schema = table(spark, folder, "events").schema
    events = file_stream(spark, folder, schema, "events.parquet")
    messages = events.select(*keyed_json(F.col("event_id"), "event_id", "user_id", "event_type", "value"))
    out = new_folder(spark, "messages")
    query = start_messages(messages, new_folder(spark, "offsets"), "parquet", {"path": out}, every=None)
    query.awaitTermination()
    body = F.from_json("value", "event_id bigint, user_id bigint, event_type string, value double")
    return spark.read.parquet(out).select("key", body.alias("body")).select("key", "body.*")


def _order_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")


def stream_irregular(spark: SparkSession, folder: str) -> DataFrame:
    """Every order once, in batches of irregular size; the stream is stopped on its way and taken up again."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    numbered = materialize(number_rows(orders, [F.col("o_orderkey")], "id"), "numbered-orders")
    total = numbered.count()
    out, checkpoint = new_folder(spark, "irregular"), new_folder(spark, "offsets")
    for batches in (3, 0):
        rows = irregular_rows(
            spark, seed=7, rows=total / 8, rowsSpread=total / 20, seconds=0, secondsSpread=0, total=total, batches=batches
        )
        sent = rows.join(numbered, "id").select("batch", "o_orderkey", "o_orderstatus")
        query = start_messages(sent, checkpoint, "parquet", {"path": out}, every="0 seconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    got = spark.read.parquet(out)
    sizes = got.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"))
    irregular = sizes.agg((F.count_distinct("rows") > 3).alias("is_irregular"))
    return got.groupBy("o_orderkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("sent")).crossJoin(F.broadcast(irregular))


def stream_sink_commit(spark: SparkSession, folder: str) -> DataFrame:
    """Events through the committing sink; the second epoch is run again after its commit, as after a failure."""
    files = new_folder(spark, "event-files")
    _order_events(spark, folder).repartitionByRange(4, "event_id").write.parquet(files)
    stream = spark.readStream.schema(spark.read.parquet(files).schema).option("maxFilesPerTrigger", 1).parquet(files)
    messages = stream.select(*keyed_json(F.col("event_id"), "event_id", "user_id", "event_type", "value"))
    path, checkpoint = new_folder(spark, "committed"), new_folder(spark, "offsets")
    start_committed(messages, path, checkpoint).awaitTermination()
    Storage(spark).remove(f"{checkpoint}/commits/2")
    Storage(spark).remove(f"{checkpoint}/commits/3")
    start_committed(messages, path, checkpoint).awaitTermination()
    body = F.from_json("value", "event_id bigint, user_id bigint, event_type string, value double")
    rows = read_committed(spark, path).select("key", "epoch", body.alias("body"))
    epochs = rows.select(F.count_distinct("epoch").alias("epochs"))
    return rows.select("key", "body.*").crossJoin(F.broadcast(epochs))


def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """What the log of a stream says of its batches, in sum: all events, and the span of their ids."""
    files, log = new_folder(spark, "event-files"), new_folder(spark, "progress")
    _order_events(spark, folder).repartitionByRange(4, "event_id").write.parquet(files)
    stream = spark.readStream.schema(spark.read.parquet(files).schema).option("maxFilesPerTrigger", 1).parquet(files)
    listener = ProgressLog(qualified(spark, log))
    spark.streams.addListener(listener)
    try:
        sent = spanned(stream, F.col("event_id"))
        out = {"path": new_folder(spark, "sent")}
        start_messages(sent, new_folder(spark, "offsets"), "parquet", out, every=None).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    return progress_table(spark, log).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("row_count").alias("row_count"),
        F.min(F.col("first_id").cast("bigint")).alias("first_id"), F.max(F.col("last_id").cast("bigint")).alias("last_id"),
    )


def _choice_sql() -> str:
    """Digits of ``o_orderkey % product``, most significant dimension first."""
    stride, parts = 1, []
    for name, values in reversed(SALES_DIMENSIONS.items()):
        listed = ", ".join(repr(v) for v in values)
        parts.append(f"([{listed}])[CAST(o_orderkey // {stride} % {len(values)} AS INTEGER) + 1] AS {name}")
        stride *= len(values)
    return ", ".join(reversed(parts))


JOBS = {
    "keyed_json_batch": (
        keyed_json_batch,
        f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS key, {', '.join(LABELS)},
               round(o_totalprice * 4 * CAST(factor AS DOUBLE), 2) AS sales, o_orderkey AS transaction_id
        FROM (SELECT o_orderkey, o_totalprice, {_choice_sql()} FROM orders)
        """,
    ),
    "stream_irregular": (
        stream_irregular,
        "SELECT o_orderkey, o_orderstatus, CAST(1 AS BIGINT) AS sent, TRUE AS is_irregular FROM orders",
    ),
    "stream_sink_commit": (
        stream_sink_commit,
        "SELECT CAST(event_id AS VARCHAR) AS key, event_id, user_id, event_type, value, CAST(4 AS BIGINT) AS epochs FROM events",
    ),
    "stream_progress": (
        stream_progress,
        "SELECT CAST(4 AS BIGINT) AS batches, count(*) AS row_count, min(event_id) AS first_id, max(event_id) AS last_id FROM events",
    ),
    "stream_keyed_json": (
        stream_keyed_json,
        "SELECT CAST(event_id AS VARCHAR) AS key, event_id, user_id, event_type, value FROM events",
    ),
}
