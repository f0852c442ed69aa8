"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.workspace import materialize

#: Tables up to this size, by measured rows times an upper bound of their row size, may be broadcast.
BROADCAST_BYTES = 64 << 20

_POSITION_BITS = 33


def column(name: str):
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(names: list[str]) -> list:
    return [column(name) for name in names]


def free_name(taken: list[str], wish: str) -> str:
    """``wish``, with underscores before it until no column has that name (case does not count)."""
    lower = {name.lower() for name in taken}
    while wish.lower() in lower:
        wish = "_" + wish
    return wish


def empty_as_text(name: str):
    return F.coalesce(column(name), F.lit(""))


def hint_small(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its rows times ``row_bytes`` stay below the bound; else for Spark to shuffle.

    ``df`` should be a written table, whose rows are counted from its footers.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def running_total(df: DataFrame, order_by: list[str], value: str, name: str, label: str) -> DataFrame:
    """``df`` plus the sum of ``value`` over all rows before each one, in ``order_by`` order.

    Rows are range-sorted and written once; each range sums its own rows and is shifted
    by the totals of the ranges before it, of which there are as many as the write had
    tasks. No single task sees more than its range. ``order_by`` should be a total order.
    """
    serial = F.monotonically_increasing_id()
    taken = df.columns
    part, at = free_name(taken, "_range"), free_name(taken, "_at")
    written = materialize(
        df.repartitionByRange(*columns(order_by)).sortWithinPartitions(*columns(order_by)).withColumns({
            part: F.shiftright(serial, _POSITION_BITS), at: serial,
        }), label,
    )
    size, before = free_name(taken, "_size"), free_name(taken, "_before")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = written.groupBy(part).agg(F.sum(column(value)).alias(size)).select(
        part, F.coalesce(F.sum(size).over(earlier), F.lit(0)).cast("bigint").alias(before)
    )
    inside = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(column(value)).over(inside), F.lit(0)).cast("bigint")
    return written.withColumn(name, own).join(F.broadcast(offsets), part).select(
        *columns([c for c in taken if c != name]), (column(name) + column(before)).alias(name)
    )


def smallest_labels(edges: DataFrame, spark: SparkSession) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; component is the smallest node reachable.

    Alternates two steps until nothing changes: every node's larger neighbours, then its
    smaller ones, are linked to the smallest node around it. The number of rounds grows
    with the logarithm of the longest path. Edges are reduced to distinct ones before
    each shuffle, and each round is a written table, so neither lineage nor driver grow.
    """
    pairs = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges",
        rows=edges.count(),
    )
    print_of = _fingerprint(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        around = both.groupBy("a").agg(F.min("b").alias("low"))
        # Large step: neighbours above a node go to the smallest node around it.
        large = both.where("b > a").join(around, "a").select(F.col("b").alias("a"), F.least("low", "a").alias("b")).where("a > b").distinct()
        # Small step: a node and its neighbours below it go to the smallest of these.
        lows = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(lows, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        pairs = materialize(small.where("a > b").distinct(), "small", rows=2 * print_of[0])
        before, print_of = print_of, _fingerprint(pairs)
        if print_of == before:
            break
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _fingerprint(pairs: DataFrame) -> tuple:
    """Number of pairs and two sums of their hashes: the same for the same set."""
    hashes = (F.xxhash64("a", "b"), F.xxhash64(F.lit(7), "b", "a"))
    return tuple(pairs.agg(F.count(F.lit(1)), *[F.sum(h.cast("decimal(38,0)")) for h in hashes]).first())
