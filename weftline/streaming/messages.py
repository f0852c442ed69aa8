"""Keyed JSON messages: batches drawn from a product of dimensions, and streams to any sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from weftline.functions.strings import keyed_json
from weftline.operators.product import combination, product_size
from weftline.workspace import exact_path

# The sales dimensions; their product has 23,040 rows.
SALES_DIMENSIONS = {
    "color": ["red", "blue", "green", "yellow", "orange"],
    "region": ["north", "south", "east", "west"],
    "tier": ["basic", "premium"],
    "finish": ["glossy", "matte"],
    "size": ["small", "medium", "large"],
    "transit": ["delivery", "pickup"],
    "packaging": ["cardboard", "plastic"],
    "accent": ["none", "chrome", "gold"],
    "factor": [1.0, 1.25, 1.5, 1.75, 2.0, 2.5, 3.0, 4.0],
}
# Batches of about 75 rows every 10 seconds, prices spread around 50.
BATCH_ROWS = 75
BATCH_SECONDS = 10
PRICE_SPREAD = 50

LABELS = [name for name in SALES_DIMENSIONS if name != "factor"]

# ``value`` of one message.
MESSAGE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in LABELS]
    + [T.StructField("sales", T.DoubleType()), T.StructField("transaction_id", T.LongType())]
)


def sales_messages(rows: DataFrame, transaction_id: Column, choice: Column, price: Column) -> DataFrame:
    """One ``(key, value)`` message per input row.

    ``choice`` picks the row's combination of dimensions, ``price`` is multiplied by that
    combination's factor. The factor itself is not part of the message. The key is the
    caller's stable id, so a batch that is sent twice can be recognised.
    """
    picked = combination(F.pmod(choice, F.lit(product_size(SALES_DIMENSIONS))), SALES_DIMENSIONS)
    sales = F.round(price * picked["factor"], 2)
    columns = [picked[name].alias(name) for name in LABELS]
    shaped = rows.select(*columns, sales.alias("sales"), transaction_id.cast("bigint").alias("transaction_id"))
    return shaped.select(*keyed_json(F.col("transaction_id"), *shaped.columns))


def random_sales_messages(rows: DataFrame, row_id: str, seed: int | None = None) -> DataFrame:
    """Messages with a random combination and price per input row."""
    size = product_size(SALES_DIMENSIONS)
    return sales_messages(
        rows, F.col(row_id), F.floor(F.rand(seed) * F.lit(size)),
        F.rand(None if seed is None else seed + 1) * F.lit(PRICE_SPREAD),
    )


def sales_stream(spark: SparkSession, rows_per_second: float = BATCH_ROWS / BATCH_SECONDS) -> DataFrame:
    """An endless stream of sales messages at about the given rate."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", max(1, round(rows_per_second))).load()
    return random_sales_messages(ticks, "value")


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, name: str | None = None) -> DataFrame:
    """A stream over the Parquet files of ``folder``, or of ``name`` in it, be that a file or a folder of parts."""
    return spark.readStream.schema(schema).parquet(exact_path(f"{folder}/{name}") if name else folder)


def kafka_options(servers: str, topic: str, jaas: str | None = None) -> dict[str, str]:
    """Sink options; with ``jaas`` the connection is SASL/PLAIN over TLS."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if jaas:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": jaas,
        }
    return options


def start_messages(
    messages: DataFrame,
    checkpoint: str,
    sink: str = "kafka",
    options: dict[str, str] | None = None,
    every: str | None = f"{BATCH_SECONDS} seconds",
) -> StreamingQuery:
    """Stream ``(key, value)`` rows to ``sink``; ``every=None`` drains what is there and stops.

    The checkpoint folder carries offsets across restarts: file sinks get each message once,
    Kafka at least once.
    """
    writer = messages.writeStream.format(sink).options(**(options or {}))
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def write_messages(messages: DataFrame, sink: str = "kafka", options: dict[str, str] | None = None) -> None:
    """Send one bounded batch."""
    messages.write.format(sink).options(**(options or {})).mode("append").save()


def progress_lines(query: StreamingQuery) -> list[str]:
    """Rows and start time of each finished micro-batch, newest last."""
    return [f"{p.numInputRows:,} rows at {p.timestamp} (batch {p.batchId})" for p in query.recentProgress]
