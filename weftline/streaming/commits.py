"""A stream sink with a commit of its own: every epoch appears as a whole, and once.

Tasks write Parquet files of new names below ``data``; only when all are written is the
epoch's list of files put below ``commits``, by one move. An epoch that is run again after
a failure finds its list there and leaves it, so its files are not read twice. Readers
take the files that some list names; the others are left-overs.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from weftline.sources.files import open_store
from weftline.workspace import Storage

#: Rows a task writes to one file.
FILE_ROWS = 1_000_000


@dataclass
class _Written(WriterCommitMessage):
    files: list


class _Writer(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator) -> _Written:
        import pyarrow.parquet as pq

        store, inner = open_store(f"{self.path}/data")
        store.create_dir(inner, recursive=True)
        files: list[dict] = []
        out = None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None or files[-1]["rows"] >= FILE_ROWS:
                if out is not None:
                    out.close()
                files.append({"name": f"part-{uuid.uuid4().hex}.parquet", "rows": 0})
                out = pq.ParquetWriter(f"{inner}/{files[-1]['name']}", batch.schema, filesystem=store)
            out.write_batch(batch)
            files[-1]["rows"] += batch.num_rows
        if out is not None:
            out.close()
        return _Written(files)

    def commit(self, messages: list, batchId: int) -> None:
        store, inner = open_store(f"{self.path}/commits")
        store.create_dir(inner, recursive=True)
        target = f"{inner}/{batchId:010d}.json"
        from pyarrow.fs import FileType

        if store.get_file_info(target).type != FileType.NotFound:
            return  # this epoch was committed before
        files = [{"epoch": batchId, **f} for m in messages if m is not None for f in m.files]
        staged = f"{inner}/.{batchId:010d}-{uuid.uuid4().hex}"
        with store.open_output_stream(staged) as stream:
            stream.write("".join(json.dumps(f) + "\n" for f in files).encode())
        store.move(staged, target)

    def abort(self, messages: list, batchId: int) -> None:
        store, inner = open_store(f"{self.path}/data")
        for message in messages:
            for file in message.files if message is not None else ():
                store.delete_file(f"{inner}/{file['name']}")


class CommittedFiles(DataSource):
    """Format ``weftline_commits``; option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "weftline_commits"

    def schema(self) -> str:
        return "key string, value string"

    def streamWriter(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def start_committed(
    messages: DataFrame, path: str, checkpoint: str, every: str | None = None, once_per_key: str | None = "key"
) -> StreamingQuery:
    """Stream ``messages`` to the sink at ``path``; ``every=None`` drains what is there and stops.

    ``once_per_key`` names a column whose values are let through once per epoch.
    """
    spark = messages.sparkSession
    spark.dataSource.register(CommittedFiles)
    path = qualified(spark, path)

    def once(batch: DataFrame, number: int) -> None:
        # Runs as one write per epoch; the epoch's number decides whether it still counts.
        if committed_epochs(spark, path, number):
            return
        out = batch.dropDuplicates([once_per_key]) if once_per_key else batch
        write_epoch(out, path, number)

    writer = messages.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    if once_per_key is None:
        return writer.format("weftline_commits").option("path", path).trigger(**trigger).start()
    return writer.foreachBatch(once).trigger(**trigger).start()


def qualified(spark: SparkSession, path: str) -> str:
    fs, at = Storage(spark)._at(path)
    return fs.makeQualified(at).toString()


def committed_epochs(spark: SparkSession, path: str, number: int) -> bool:
    return Storage(spark).exists(f"{path}/commits/{number:010d}.json")


def write_epoch(rows: DataFrame, path: str, number: int) -> None:
    """Write one epoch with the same files and the same commit as the stream sink does."""
    writer = _Writer(path)

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        written = writer.write(batches)
        yield pa.RecordBatch.from_pydict(
            {"name": [f["name"] for f in written.files], "rows": [f["rows"] for f in written.files]},
            schema=pa.schema([("name", pa.string()), ("rows", pa.int64())]),
        )

    files = rows.mapInArrow(write, "name string, rows bigint").collect()  # a line per file of this epoch
    writer.commit([_Written([f.asDict() for f in files])], number)


def read_committed(spark: SparkSession, path: str, schema: str = "key string, value string") -> DataFrame:
    """The rows of all committed epochs, with the epoch each came in."""
    if not Storage(spark).exists(f"{path}/commits"):
        return spark.createDataFrame([], f"{schema}, epoch bigint")
    named = spark.read.schema("epoch bigint, name string, rows bigint").json(f"{path}/commits")
    rows = spark.read.schema(schema).parquet(f"{path}/data")
    return rows.select("*", F.col("_metadata.file_name").alias("name")).join(named.select("epoch", "name"), "name").drop("name")
