"""What every batch of a stream has brought, kept as a table."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from weftline.sources.files import open_store

SPAN = "weftline_span"
_LINE = (
    "query string, run string, batch bigint, started timestamp, row_count bigint, input_rows bigint, "
    "first_id string, last_id string, seconds double"
)


def spanned(stream: DataFrame, row_id: Column) -> DataFrame:
    """``stream``, with rows and smallest and largest id observed in every batch."""
    return stream.observe(
        SPAN, F.count(F.lit(1)).alias("row_count"), F.min(row_id).cast("string").alias("first_id"), F.max(row_id).cast("string").alias("last_id")
    )


class ProgressLog(StreamingQueryListener):
    """Writes a line for every finished batch of every stream that ``spanned`` observes, below ``folder``.

    A query's own list of progress forgets old batches and ends with it; these lines stay.
    A batch that is run again overwrites its line.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        span = progress.observedMetrics.get(SPAN)
        if span is None or not span["row_count"]:
            return
        line = {
            "query": str(progress.id), "run": str(progress.runId), "batch": progress.batchId, "started": progress.timestamp,
            "row_count": span["row_count"], "input_rows": progress.numInputRows, "first_id": span["first_id"],
            "last_id": span["last_id"], "seconds": progress.batchDuration / 1000,
        }
        store, inner = open_store(f"{self.folder}/query={progress.id}")
        store.create_dir(inner, recursive=True)
        with store.open_output_stream(f"{inner}/batch-{progress.batchId:010d}.json") as out:
            out.write((json.dumps(line) + "\n").encode())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per batch of the streams logged below ``folder``."""
    return spark.read.schema(_LINE).json(f"{folder}/*")


def progress_lines(table: DataFrame) -> DataFrame:
    """The lines of ``progress_table`` as text, as a person reads them."""
    return table.select("query", "batch", F.format_string(
        "%s rows at %s (batch %d)", F.format_number("row_count", 0), F.date_format("started", "yyyy-MM-dd HH:mm:ss"), "batch"
    ).alias("line"))
