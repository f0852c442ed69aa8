"""A reproducible shuffle into shards: every row's place is computed from its row number.

Rows are numbered from 0 in a total order. A Feistel network over a x b, the smallest
near-square that holds all rows, permutes these numbers; a number that leaves the range
of rows walks on along its cycle until it is back. The place p of a row gives shard
p mod n and slot p div n, so shards differ by one row at most, slots have no gap, and the
place of any row number can be computed without reading a table.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import column, empty_as_text, free_name
from weftline.operators.numbering import number_rows

ROUNDS = 6
SEED = 20


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("bigint"))


def _network(value: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the network: a bijection of 0 .. a*b - 1."""
    halves = F.struct((value % a).cast("bigint").alias("left"), _div(value, a).alias("right"))

    def step(pair: Column, number: Column) -> Column:
        left, right = pair["left"], pair["right"]
        even = F.pmod(left + F.pmod(F.xxhash64(right, number + F.lit(seed * 1_000)), F.lit(a)), F.lit(a))
        odd = F.pmod(right + F.pmod(F.xxhash64(left, number + F.lit(seed * 1_000)), F.lit(b)), F.lit(b))
        turn = number % 2 == 0
        return F.struct(
            F.when(turn, even).otherwise(left).cast("bigint").alias("left"),
            F.when(turn, right).otherwise(odd).cast("bigint").alias("right"),
        )

    steps = F.array(*[F.lit(n).cast("bigint") for n in range(ROUNDS)])
    return F.aggregate(steps, halves, step, lambda pair: pair["right"] * a + pair["left"])


def sides(rows: int) -> tuple[int, int]:
    """a and b with a * b >= rows; fewer than a numbers lie beyond the rows."""
    a = max(1, isqrt(rows))
    return a, max(1, -(-rows // a))


def longest_walk(spark: SparkSession, rows: int, seed: int = SEED) -> int:
    """Passes that bring every row number back into the range.

    Numbers outside the range are fewer than the square root of the rows. They are
    followed until none is left outside; each pass keeps about one in a square root.
    """
    a, b = sides(rows)
    outside, passes = spark.range(rows, a * b), 1
    while outside.limit(1).count():
        outside = outside.select(_network(F.col("id"), a, b, seed).alias("id")).where(F.col("id") >= rows)
        passes += 1
    return passes


def permuted(number: Column, rows: int, passes: int, seed: int = SEED) -> Column:
    """The place of a row number among ``rows``; ``passes`` as given by ``longest_walk``."""
    a, b = sides(rows)
    walk = F.array(*[F.lit(n) for n in range(passes - 1)]) if passes > 1 else F.array().cast("array<int>")
    return F.aggregate(
        walk, _network(number.cast("bigint"), a, b, seed),
        lambda at, _: F.when(at < rows, at).otherwise(_network(at, a, b, seed)),
    )


def assign_shards(
    rows: DataFrame, order_by: list[str], shards: int, *, seed: int = SEED, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """``rows`` plus shard (0 .. shards - 1) and slot (from 0 without a gap in each shard).

    ``order_by`` should be a total order; rows equal in it are interchangeable and get
    separate places. Nulls come first in the order. An empty table stays empty. Columns
    named like a new one are replaced. Only the given columns travel: hand over keys, not
    texts, and join the result.
    """
    kept = rows.drop(*[c for c in rows.columns if c.lower() in (shard.lower(), slot.lower())])
    number = free_name(kept.columns, "number")
    numbered = number_rows(kept, [column(c) for c in order_by], number)
    count = numbered.count()
    place = free_name(numbered.columns, "place")
    passes = longest_walk(rows.sparkSession, count, seed) if count else 1
    placed = numbered.withColumn(place, permuted(column(number), max(count, 1), passes, seed))
    return placed.select(
        *[column(c) for c in kept.columns],
        F.pmod(column(place), F.lit(shards)).cast("int").alias(shard),
        _div(column(place), shards).alias(slot),
    )


def shard_digest(docs: DataFrame, shards: int, *, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Shard and slot of every document, with the size and CRC-32 of its text; texts are not moved.

    Size is the text's UTF-8 bytes plus one; a null text counts as empty. Rows with equal
    ids and texts are separate rows. The law is ``rows``: shard sizes are at most one apart.
    """
    digest = docs.select(
        column(doc_id).alias("doc_id"),
        (F.octet_length(empty_as_text(text)) + 1).cast("bigint").alias("size"),
        F.crc32(empty_as_text(text).cast("binary")).alias("text_crc32"),
    )
    placed = assign_shards(digest, ["doc_id", "text_crc32", "size"], shards, seed=seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def write_shards(rows: DataFrame, path: str, *, shard: str = "shard", slot: str = "slot", files_per_shard: int = 1) -> None:
    """Write placed rows as Parquet, one folder per shard, in slot order.

    A shard is split into ``files_per_shard`` stretches of slots, so one shard is never
    one task's work at large sizes.
    """
    stretch = F.pmod(F.xxhash64(column(slot)), F.lit(files_per_shard))
    rows.repartition(column(shard), stretch).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
