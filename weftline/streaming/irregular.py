"""A stream source of irregular batches that can be replayed: sizes and pauses follow a seed.

The source gives one line per batch: its number, its first row's number and how many rows
it has. Spark makes the rows from that. An offset holds all that the next batch follows
from, so after a restart the stream goes on as if it had never stopped, and a batch that
is run again is the same batch.
"""

from __future__ import annotations

import random
import time
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.types import StructType

from weftline.streaming.messages import BATCH_ROWS, BATCH_SECONDS

# How far batch sizes and pauses spread around their means.
ROWS_SPREAD = 25
SECONDS_SPREAD = 4


class BatchPlan:
    """Size and pause of every batch; a pause is in seconds, and passes before the batch is due."""

    def __init__(self, options: Mapping[str, str]):
        self.seed = int(options.get("seed", 0))
        self.rows = float(options.get("rows", BATCH_ROWS)), float(options.get("rowsSpread", ROWS_SPREAD))
        self.seconds = float(options.get("seconds", BATCH_SECONDS)), float(options.get("secondsSpread", SECONDS_SPREAD))
        self.batches = int(options.get("batches", 0))
        self.total = int(options.get("total", 0))

    def batch(self, number: int) -> tuple[int, float]:
        own = random.Random(self.seed * 1_000_003 + number)
        return round(abs(own.gauss(*self.rows))), abs(own.gauss(*self.seconds))

    def after(self, offset: dict) -> tuple[tuple, dict] | None:
        """The batch after an offset and the offset after that; None when all are given out."""
        number, first = offset["batch"], offset["first"]
        if (self.batches and number >= self.batches) or (self.total and first >= self.total):
            return None
        rows, pause = self.batch(number)
        if self.total:
            rows = min(rows, self.total - first)
        return (number, first, rows), {"batch": number + 1, "first": first + rows, "due": offset["due"] + pause}


class _Reader(SimpleDataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.plan = BatchPlan(options)
        self.started = time.time()
        self.base: float | None = None

    def initialOffset(self) -> dict:
        return {"batch": 0, "first": 0, "due": 0.0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if self.base is None:
            self.base = start["due"]  # pauses count from where this run began
        step = self.plan.after(start)
        if step is None or time.time() - self.started < step[1]["due"] - self.base:
            return iter([]), start
        return iter([step[0]]), step[1]

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        rows = []
        while start["batch"] < end["batch"]:
            row, start = self.plan.after(start)
            rows.append(row)
        return iter(rows)


class IrregularBatches(DataSource):
    """Format ``weftline_batches``. Options: ``seed``, ``rows``, ``rowsSpread``, ``seconds``, ``secondsSpread``; ``batches`` or
    ``total`` rows after which the source is empty."""

    @classmethod
    def name(cls) -> str:
        return "weftline_batches"

    def schema(self) -> str:
        return "batch bigint, first bigint, rows bigint"

    def simpleStreamReader(self, schema: StructType) -> _Reader:
        return _Reader(self.options)


def irregular_rows(spark: SparkSession, **options: object) -> DataFrame:
    """(batch, id): an endless or bounded stream of numbered rows in irregular batches."""
    spark.dataSource.register(IrregularBatches)
    lines = spark.readStream.format("weftline_batches").options(**{k: str(v) for k, v in options.items()}).load()
    numbers = F.when(F.col("rows") > 0, F.sequence(F.col("first"), F.col("first") + F.col("rows") - 1))
    return lines.select("batch", F.explode(numbers).alias("id"))
