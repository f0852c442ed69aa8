"""Tables clustered on several columns at once, by a space-filling curve."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.workspace import Storage

#: Ranks per column are numbers of so many bits; the curve key has as many for each column.
RANK_BITS = 8
#: Error of the quantiles, as a share of the rows.
QUANTILE_ERROR = 0.002


def sortable(column: Column, kind: T.DataType) -> Column:
    """``column`` as a double that is ordered like it; of text the first six bytes decide."""
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    return column.cast("double")


def _levels(bounds: list[float], bits: int) -> list[list[float]]:
    """Sorted bounds as a search tree: level k has the 2^k bounds that decide bit k."""
    size = 1 << bits
    levels = []
    for k in range(bits):
        step = size >> k
        levels.append([bounds[min(len(bounds) - 1, at * step + step // 2 - 1)] for at in range(1 << k)])
    return levels


def quantile_rank(value: Column, bounds: list[float], bits: int = RANK_BITS) -> Column:
    """How many of the 2^bits - 1 sorted bounds are at or below ``value``; 0 for NULL. One comparison a bit."""
    if not bounds:
        return F.lit(0)
    levels = F.array(*[F.array(*[F.lit(float(b)) for b in level]) for level in _levels(bounds, bits)])
    rank = F.aggregate(levels, F.lit(0), lambda r, level: r * 2 + F.when(value >= F.get(level, r), 1).otherwise(0))
    return F.coalesce(rank, F.lit(0))


def interleaved(ranks: list[Column], bits: int = RANK_BITS) -> Column:
    """The Morton key: the ranks' bits in turn, highest first."""
    key = F.lit(0).cast("bigint")
    for bit in reversed(range(bits)):
        for rank in ranks:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(rank.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint")))
    return key


def curve_key(df: DataFrame, columns: list[str], bits: int = RANK_BITS) -> Column:
    """The place of each row of ``df`` on a curve through the quantile ranks of ``columns``.

    All quantiles come from one pass. Ranks and not values make up the key, so skewed
    columns use all their bits, and no column outweighs another by its scale.
    """
    if not columns or bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not make a key of 62 bits")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = [sortable(F.col(c), kinds[c]) for c in columns]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    accuracy = math.ceil(1 / QUANTILE_ERROR)
    row = df.agg(*[F.percentile_approx(v, shares, accuracy).alias(f"q{i}") for i, v in enumerate(values)]).first()
    return interleaved([quantile_rank(v, row[f"q{i}"] or [], bits) for i, v in enumerate(values)], bits)


def compact_curve(
    spark: SparkSession, source: str, target: str, partition_by: list[str], cluster_by: list[str],
    file_bytes: int = 256 << 20, bits: int = RANK_BITS,
) -> DataFrame:
    """Rewrite the Parquet dataset ``source`` to ``target`` so that filters on any of ``cluster_by`` skip files.

    Rows are range-split on partition columns, curve key and a salt per row, so a file holds
    a small box of the clustering columns' values, and neither a hot partition nor a hot
    value ends up in one task. Within a file rows follow the curve, so row groups are boxes
    as well. ``source`` is left alone.
    """
    ranges = max(1, math.ceil(Storage(spark).bytes_under(source) / file_bytes))
    rows = spark.read.parquet(source)
    keyed = rows.select("*", curve_key(rows, cluster_by, bits).alias("_curve"), F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_salt"))
    (
        keyed.repartitionByRange(ranges, *partition_by, "_curve", "_salt")
        .sortWithinPartitions(*partition_by, "_curve")
        .drop("_curve", "_salt")
        .write.partitionBy(*partition_by).parquet(target)
    )
    return spark.read.schema(rows.schema).parquet(target)
