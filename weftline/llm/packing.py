"""Packing of token sequences from many sources by deficit round-robin.

Every source is a queue of tokens in row order. In each round a source's credit grows by
its target share of a window; it sends as many whole quanta as the credit covers and
carries the deficit into the next round. The quantum that ends at token e of a queue is
therefore sent in round ceil(e / (share x window)), for every quantum at once: no task
has to play the rounds in turn, and no deficit is lost between windows or partitions.
Quanta in (round, source, number) order fill one window after the other without a gap.
What is left at the end is cut into powers of two, so no padding is needed at all.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import BROADCAST_BYTES, column, running_total
from weftline.llm.linking import small_batches
from weftline.llm.pair_index import encoded_chunks
from weftline.workspace import materialize

WINDOW = 2048
QUANTUM = 256
END_ID = 1

_PIECE_FIELDS = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, `offset` bigint, source string"
)


def _encoded(docs: DataFrame, path: str, end_id: int, doc_id: str, text: str, source: str) -> DataFrame:
    """One row per document: key, id, source, number of tokens, ids of two bytes each."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, counts in encoded_chunks(batches, "text", path):
            # The end id goes behind the ids of each row.
            ends = np.cumsum(counts)
            stored = np.insert(ids.astype("<u2"), ends, end_id)
            offsets = np.concatenate([[0], 2 * (ends + np.arange(1, len(ends) + 1))]).astype(np.int64)
            packed = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(stored)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(counts + 1), packed], names=["key", "doc_id", "source", "tokens", "ids"]
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("key"), column(doc_id).cast("bigint").alias("doc_id"),
        F.coalesce(column(source).cast("string"), F.lit("")).alias("source"), column(text).alias("text"),
    )
    return rows.mapInArrow(encode, "key bigint, doc_id bigint, source string, tokens bigint, ids binary")


def tail_lengths(rest: int) -> list[int]:
    """``rest`` as falling powers of two."""
    return [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def pack(
    docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    shares: dict[str, float] | None = None, window: int = WINDOW, quantum: int = QUANTUM, end_id: int = END_ID,
) -> DataFrame:
    """All tokens of ``docs`` in windows of ``window`` tokens, one row per piece of a document.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source. A
    document's tokens are those of its text and ``end_id``. ``shares`` are the target
    proportions by source; sources without one, and all without ``shares``, share by
    their token counts. A source that runs out leaves its room to the others.

    Null or empty texts are one token long. Rows with equal or null ids are separate
    documents; a null source is the source "". Ties in order cannot occur: rows have
    keys of their own. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        encoded = materialize(_encoded(docs, path, end_id, doc_id, text, source), "encoded")
    queues = running_total(encoded.select("key", "source", "tokens"), ["source", "key"], "tokens", "at", "queues")
    queues = materialize(queues, "queued")
    per_source = materialize(
        queues.groupBy("source").agg(F.min("at").alias("queue_start"), F.sum("tokens").alias("queue_tokens")), "sources"
    )
    all_tokens = per_source.agg(F.sum("queue_tokens")).first()[0] or 0
    weight = F.col("queue_tokens").cast("double")
    if shares:
        given = spark.createDataFrame([(k, float(v)) for k, v in shares.items()], "source string, share double")
        # A source without a share keeps its part of the tokens; the given shares divide the rest.
        totals = per_source.join(F.broadcast(given), "source", "left")
        sums = totals.agg(
            F.coalesce(F.sum(F.when(F.col("share").isNotNull(), F.col("queue_tokens"))), F.lit(0)), F.sum("share")
        ).first()
        weight = F.coalesce(F.col("share") * F.lit(float(sums[0]) / (sums[1] or 1.0)), weight)
        per_source = totals
    credit = weight * F.lit(window / max(all_tokens, 1))
    per_source = per_source.select("source", "queue_start", "queue_tokens", credit.alias("credit"))

    # Quanta come from the documents in which they begin, so that as many tasks make them as hold documents.
    small = per_source.select("source", "queue_start", "queue_tokens", "credit")
    small = F.broadcast(small) if small.count() * 256 <= BROADCAST_BYTES else small
    placed_docs = queues.join(small, "source").withColumn("at", F.col("at") - F.col("queue_start"))
    first, behind = F.expr(f"(at + {quantum - 1}) div {quantum}"), F.expr(f"(at + tokens + {quantum - 1}) div {quantum}")
    begun = F.when(behind > first, F.sequence(first, behind - 1))
    quanta = placed_docs.select("source", "queue_tokens", "credit", F.explode(begun).alias("quantum"))
    ends = F.least((F.col("quantum") + 1) * quantum, F.col("queue_tokens"))
    quanta = quanta.select(
        "source", "quantum", (ends - F.col("quantum") * quantum).alias("size"), F.ceil(ends / F.col("credit")).alias("round")
    )
    placed = running_total(quanta, ["round", "source", "quantum"], "size", "position", "quanta")

    # A document's stretch of its queue, cut at the quanta.
    stretches = placed_docs.select("key", "source", "at", "tokens").withColumn("quantum", F.explode(F.sequence(
        F.expr(f"at div {quantum}"), F.expr(f"(at + tokens - 1) div {quantum}")
    )))
    cuts = stretches.join(placed.select("source", "quantum", "position"), ["source", "quantum"])
    left = F.greatest(F.col("at"), F.col("quantum") * quantum)
    right = F.least(F.col("at") + F.col("tokens"), (F.col("quantum") + 1) * quantum)
    cuts = cuts.select(
        "key", (left - F.col("at")).alias("start"), (right - left).alias("length"),
        (F.col("position") + left - F.col("quantum") * quantum).alias("position"),
    )
    # One list per document, as long as the document has quanta.
    plan = cuts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "position"))).alias("cuts"))
    plan = plan.select("key", *[F.col(f"cuts.{part}").alias(part) for part in ("start", "length", "position")])
    cut = encoded.join(plan, "key").select("doc_id", "tokens", "source", "ids", "start", "length", "position")
    with small_batches(spark):
        return materialize(cut.mapInPandas(_pieces(window, all_tokens), _PIECE_FIELDS), "pieces")


def _pieces(window: int, all_tokens: int):
    full = all_tokens // window
    tail_starts = list(accumulate(tail_lengths(all_tokens % window), initial=full * window))

    def windows(start: int, size: int, position: int) -> Iterator[tuple[int, int, int, int]]:
        """(start, length, sequence, offset) of the parts of one stretch."""
        while size > 0:
            if position < full * window:
                sequence, offset = divmod(position, window)
                room = window - offset
            else:
                n = bisect_right(tail_starts, position) - 1
                sequence, offset, room = full + n, position - tail_starts[n], tail_starts[n + 1] - position
            part = min(room, size)
            yield start, part, sequence, offset
            start, size, position = start + part, size - part, position + part

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, tokens, source, stored, *cuts in batch.itertuples(index=False, name=None):
                ids, pieces = memoryview(np.frombuffer(stored, "<u2").astype("<u4")).cast("B"), []
                for stretch in zip(*cuts, strict=True):
                    for start, size, sequence, offset in windows(*map(int, stretch)):
                        last = pieces[-1] if pieces else None
                        if last and last[2] == sequence and last[3] + last[1] == offset:
                            last[1] += size  # neighbouring quanta of one window are one piece
                        else:
                            pieces.append([start, size, sequence, offset])
                out.extend(
                    (doc, start, size, zlib.crc32(ids[4 * start: 4 * (start + size)]), tokens, sequence, offset, source)
                    for start, size, sequence, offset in pieces
                )
            yield pd.DataFrame(out, columns=[
                "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source",
            ]).astype({"doc_id": "Int64"})

    return cut
