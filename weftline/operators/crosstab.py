"""Cross-tabulated counts with row and column totals, in which every row has a place."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER, MISSING = "other", "missing"


def _counts(column: str, values: list) -> list[Column]:
    """One count per listed value, then the unlisted values, NULL, and all rows."""
    value = F.col(f"`{column}`")
    return [
        *[F.count_if(value == F.lit(v)).alias(str(v)) for v in values],
        F.count_if(value.isNotNull() & ~value.isin(*values)).alias(OTHER),
        F.count_if(value.isNull()).alias(MISSING),
        F.count(F.lit(1)).alias("total"),
    ]


def count_matrix(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """One line per ``row`` value: a count column per listed value, ``other``, ``missing``, ``total``.

    Only listed values become columns, so the width never depends on the data; rows with
    any other value are counted in ``other``. ``long_counts`` has a line for each instead.
    """
    return df.groupBy(row).agg(*_counts(column, values))


def long_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """(row, column, count) for all pairs that occur, NULL among them: the form for wide domains."""
    return df.groupBy(row, column).agg(F.count(F.lit(1)).alias("count"))


def with_totals(matrix: DataFrame, row: str, label: str = "total") -> DataFrame:
    """Add a summary line to a matrix of counts.

    The summary line is made by doubling the few aggregated lines, not by a second
    aggregate over the source, so the source is scanned once. ``sort_key`` is 0 for
    ordinary lines and 1 for the summary, which makes its place explicit.
    """
    counts = [c for c in matrix.columns if c != row]
    lines = F.array(
        F.struct(F.lit(0).alias("sort_key"), F.col(row).cast("string").alias(row)),
        F.struct(F.lit(1).alias("sort_key"), F.lit(label).alias(row)),
    )
    return (
        matrix.select(F.inline(lines), *[F.col(f"`{c}`") for c in counts])
        .groupBy("sort_key", row)
        .agg(*[F.sum(f"`{c}`").alias(c) for c in counts])
        .select(row, *[F.col(f"`{c}`") for c in counts], "sort_key")
        .orderBy("sort_key", row)
    )


def rollup_counts(df: DataFrame, row: str, column: str, values: list, label: str = "total") -> DataFrame:
    """The same report as one ROLLUP."""
    counted = df.rollup(row).agg(*_counts(column, values), F.grouping(row).cast("int").alias("sort_key"))
    named = F.when(F.col("sort_key") == 1, F.lit(label)).otherwise(F.col(row).cast("string"))
    counts = [F.col(f"`{c}`") for c in [*map(str, values), OTHER, MISSING, "total"]]
    return counted.select(named.alias(row), *counts, "sort_key").orderBy("sort_key", row)


def value_counts(df: DataFrame, column: str, name: str, limit: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; all values unless a ``limit`` is asked for."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)
    return counted if limit is None else counted.limit(limit)


def reconcile(sides: dict[str, DataFrame]) -> DataFrame:
    """One line ``(side, row_count)`` per input."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("side"), "row_count")
        for name, df in sides.items()
    ]
    return reduce(DataFrame.unionByName, counts)
