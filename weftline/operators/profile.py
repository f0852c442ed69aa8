"""Distribution profiles: moments, histograms and density curves without collecting values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.workspace import materialize

PADDING = 0.005


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One line per numeric column; a single aggregate over the source serves all of them."""
    columns = columns or numeric_columns(df)
    if not columns:
        raise ValueError("no numeric column to profile")
    parts = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        parts += [
            F.count(value).alias(f"n{i}"), F.avg(value).alias(f"mean{i}"),
            F.stddev_pop(value).alias(f"std{i}"), F.min(value).alias(f"min{i}"),
            F.max(value).alias(f"max{i}"),
        ]
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"), F.col(f"n{i}").alias("value_count"),
                F.col(f"mean{i}").alias("mean"), F.col(f"std{i}").alias("std"),
                F.col(f"min{i}").alias("min_value"), F.col(f"max{i}").alias("max_value"),
                (F.col(f"mean{i}") - F.col(f"std{i}")).alias("mean_minus_std"),
                (F.col(f"mean{i}") + F.col(f"std{i}")).alias("mean_plus_std"),
                ((F.col(f"max{i}") - F.col(f"min{i}")) * F.lit(PADDING)).alias("padding"),
            )
            for i, c in enumerate(columns)
        ]
    )
    return df.agg(*parts).select(F.inline(lines))


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, value)`` for the non-NULL values of ``columns``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("double").alias("value"))
          for c in columns]
    )
    return df.select(F.inline(pairs)).where(F.col("value").isNotNull())


def bin_counts_by_spread(df: DataFrame, columns: list[str], max_bins: int | None = None) -> dict[str, int]:
    """Freedman-Diaconis bin numbers, from one aggregate with approximate quartiles."""
    parts = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        parts += [
            F.count(value).alias(f"n{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
            F.percentile_approx(value, [0.25, 0.75], 10_000).alias(f"q{i}"),
        ]
    row = df.agg(*parts).first()
    bins = {}
    for i, c in enumerate(columns):
        n, lo, hi, quartiles = (row[f"{k}{i}"] for k in ("n", "lo", "hi", "q"))
        width = 2 * (quartiles[1] - quartiles[0]) / n ** (1 / 3) if n else 0
        wanted = math.ceil((hi - lo) / width) if width > 0 else max(1, math.isqrt(n or 1))
        bins[c] = max(1, wanted if max_bins is None else min(max_bins, wanted))
    return bins


def histogram(df: DataFrame, columns: list[str], bins: int | dict[str, int] | None = None) -> DataFrame:
    """``(column_name, bin, bin_start, bin_end, value_count, density)``, empty bins left out.

    Values are reduced to counts per bin before anything is shuffled. The maximum belongs to
    the last bin; a constant column has one bin of width 0 and no density.
    """
    if bins is None:
        bins = bin_counts_by_spread(df, columns)
    wanted = bins if isinstance(bins, dict) else {c: bins for c in columns}
    ends = profile(df, columns)
    ends = ends.select(
        "column_name", F.col("min_value").alias("lo"), F.col("max_value").alias("hi"),
        F.col("value_count").alias("total"),
        F.element_at(_literal_map(wanted), F.col("column_name")).alias("bins"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / F.col("bins"))
    # ``ends`` has one line per profiled column, so it is always small enough to send around.
    placed = _long(df, columns).join(F.broadcast(ends), "column_name")
    index = F.when(F.col("width") > 0, F.floor((F.col("value") - F.col("lo")) / F.col("width")))
    index = F.least(F.coalesce(index, F.lit(0)), F.col("bins") - 1).cast("int")
    counted = placed.groupBy("column_name", index.alias("bin")).agg(
        F.count(F.lit(1)).alias("value_count"),
        *[F.first(c).alias(c) for c in ("lo", "width", "total")],
    )
    return counted.select(
        "column_name", "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        "value_count",
        F.try_divide("value_count", F.col("total") * F.col("width")).alias("density"),
    )


def _literal_map(values: dict[str, int]) -> Column:
    entries = [F.lit(item) for pair in values.items() for item in pair]
    return F.create_map(*entries)


def kernel_density(
    df: DataFrame, column: str, grid_points: int, bandwidth: float | None = None, bins: int | None = 512
) -> DataFrame:
    """Gaussian density of ``column`` at evenly spaced points between its extremes.

    Equal values are counted once. They are first moved to the middle of their bin, which
    bounds the work by ``bins x grid_points``; the shift is at most half a bin. ``bins=None``
    takes every distinct value as it is, for columns with few of them.
    The default bandwidth is Scott's rule.
    """
    value = F.col(f"`{column}`").cast("double")
    stats = df.agg(
        F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"),
        F.stddev(value).alias("std"),
    )
    n, lo, hi = (stats.select(c).scalar() for c in ("n", "lo", "hi"))
    spread = F.lit(float(bandwidth)) if bandwidth else stats.select(
        F.col("std") * F.pow(F.col("n"), F.lit(-0.2))
    ).scalar()
    values = df.select(value.alias("x")).where(F.col("x").isNotNull())
    if bins:
        step = (hi - lo) / F.lit(bins)
        index = F.least(F.floor((F.col("x") - lo) / step), F.lit(bins - 1))
        values = values.select(F.coalesce(lo + (index + F.lit(0.5)) * step, F.col("x")).alias("x"))
    weights = values.groupBy("x").agg(F.count(F.lit(1)).alias("weight"))
    scaled = weights.select("x", "weight", n.alias("n"), lo.alias("lo"), hi.alias("hi"), spread.alias("h"))
    points = F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1)))
    at = F.col("lo") + F.col("point") * ((F.col("hi") - F.col("lo")) / F.lit(grid_points - 1))
    u = (F.col("x") - F.col("grid_x")) / F.col("h")
    share = F.col("weight") * F.exp(F.lit(-0.5) * u * u) / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return (
        scaled.select("*", points.alias("point")).select("*", at.alias("grid_x"))
        .select("point", "grid_x", share.alias("share"))
        .groupBy("point").agg(F.first("grid_x").alias("grid_x"), F.sum("share").alias("density"))
    )


def density_curves(df: DataFrame, columns: list[str] | None = None, grid_points: int = 101) -> DataFrame:
    """``(column_name, point, grid_x, density)``: Gaussian densities of all numeric columns, in two passes in all.

    The first pass takes each column's extremes, number and spread; the second divides
    every value between its two neighbouring grid points, in proportion to its nearness.
    What is left are ``grid_points`` weights a column, which are then smoothed by the kernel
    on the grid. With grid step d and bandwidth h (Scott's rule), a density is off by at
    most d^2 / (8 h^3 sqrt(2 pi)). NULL and non-finite values are left out; a column without
    values gives no rows, and one with a single value one point without density.
    """
    columns = columns or numeric_columns(df)
    if not columns:
        raise ValueError("no numeric column to profile")
    finite = F.abs("value") < F.lit(float("inf"))
    values = _long(df, columns).where(finite & ~F.isnan("value"))
    stats = values.groupBy("column_name").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").alias("n"), F.stddev("value").alias("std"),
    ).withColumns({"step": (F.col("hi") - F.col("lo")) / (grid_points - 1), "h": F.col("std") * F.pow(F.col("n"), F.lit(-0.2))})
    # One line per column, so always small enough to send around.
    stats = materialize(stats, "spreads")
    placed = values.join(F.broadcast(stats), "column_name")
    at = F.when(F.col("step") > 0, F.least((F.col("value") - F.col("lo")) / F.col("step"), F.lit(float(grid_points - 1)))).otherwise(0.0)
    left = F.least(F.floor(at), F.lit(grid_points - 2)).cast("int")
    divided = placed.groupBy("column_name", left.alias("cell")).agg(
        F.sum(at - left).alias("upper"), F.sum(1 - (at - left)).alias("lower")
    )
    weights = divided.select("column_name", F.inline(F.array(
        F.struct(F.col("cell").alias("node"), F.col("lower").alias("weight")),
        F.struct((F.col("cell") + 1).alias("node"), F.col("upper").alias("weight")),
    ))).groupBy("column_name", "node").agg(F.sum("weight").alias("weight"))
    points = F.explode(F.when(F.col("step") > 0, F.sequence(F.lit(0), F.lit(grid_points - 1))).otherwise(F.array(F.lit(0))))
    u = (F.col("point") - F.col("node")) * F.col("step") / F.col("h")
    share = F.col("weight") * F.exp(F.lit(-0.5) * u * u) / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return (
        weights.join(F.broadcast(stats), "column_name").select("*", points.alias("point"))
        .groupBy("column_name", "point").agg(
            F.first(F.col("lo") + F.col("point") * F.col("step")).alias("grid_x"),
            F.sum(F.when(F.col("h") > 0, share)).alias("density"),
        )
    )
