"""Profiles, histograms, densities, dataset headers and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftline.operators.profile import density_curves, histogram, kernel_density, profile
from weftline.operators.sampling import key_sample, key_sample_with_replacement, split_by_key
from weftline.plans.tables import table
from weftline.sinks.header import header_lines

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_BINS = 20
_GRID = 21
_CURVE_GRID = 41
_BANDWIDTH = 2.0


def profile_numeric(spark: SparkSession, folder: str) -> DataFrame:
    lines = profile(table(spark, folder, "lineitem"))
    rounded = ["mean", "std", "min_value", "max_value", "mean_minus_std", "mean_plus_std", "padding"]
    return lines.select("column_name", "value_count", *[F.round(c, 4).alias(c) for c in rounded])


def histogram_density(spark: SparkSession, folder: str) -> DataFrame:
    bars = histogram(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"], _BINS)
    return bars.select(
        "column_name", "bin", F.round("bin_start", 4).alias("bin_start"),
        F.round("bin_end", 4).alias("bin_end"), "value_count", F.round("density", 10).alias("density"),
    )


def kernel_density_job(spark: SparkSession, folder: str) -> DataFrame:
    curve = kernel_density(table(spark, folder, "lineitem"), "l_quantity", _GRID, _BANDWIDTH, bins=None)
    return curve.select("point", F.round("grid_x", 4).alias("grid_x"), F.round("density", 8).alias("density"))


def kernel_density_binned(spark: SparkSession, folder: str) -> DataFrame:
    """Scott bandwidth, values first reduced to bins: for columns with many distinct values."""
    curve = kernel_density(table(spark, folder, "lineitem"), "l_extendedprice", _GRID, bins=200)
    return curve.select("point", F.round("grid_x", 2).alias("grid_x"), F.round("density", 10).alias("density"))


def density_curves_job(spark: SparkSession, folder: str) -> DataFrame:
    """Densities of all numeric columns of the line items, scaled to the columns' ranges."""
    curves = density_curves(table(spark, folder, "lineitem"), grid_points=_CURVE_GRID)
    span = F.max("grid_x").over(Window.partitionBy("column_name")) - F.min("grid_x").over(Window.partitionBy("column_name"))
    return curves.select(
        "column_name", "point", F.round("grid_x", 4).alias("grid_x"), F.round(F.col("density") * span, 6).alias("scaled_density")
    )


def dataset_header(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    return header_lines(part, "part", "p_size")


def bounded_sample_job(spark: SparkSession, folder: str) -> DataFrame:
    """A repeatable tenth of the line items, by order and line."""
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return key_sample(items, F.concat_ws("-", "l_orderkey", "l_linenumber"), 0.1, "tenth")


def sample_replacement(spark: SparkSession, folder: str) -> DataFrame:
    """Half as many orders as there are, drawn with replacement, one row per draw."""
    orders = table(spark, folder, "orders").select("o_orderkey")
    return key_sample_with_replacement(orders, F.col("o_orderkey"), 0.5, salt="draw")


def key_split(spark: SparkSession, folder: str) -> DataFrame:
    """The repeatable 80/20 split: every order with the part it belongs to."""
    orders = table(spark, folder, "orders")
    large, small = split_by_key(orders, F.col("o_orderkey"), 0.2, "split")
    return large.select("o_orderkey", F.lit("large").alias("part")).unionByName(
        small.select("o_orderkey", F.lit("small").alias("part"))
    )


def _profile_sql(column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"""
    SELECT '{column}' AS column_name, count({column}) AS value_count, round(avg({v}), 4) AS mean,
           round(stddev_pop({v}), 4) AS std, round(min({v}), 4) AS min_value,
           round(max({v}), 4) AS max_value, round(avg({v}) - stddev_pop({v}), 4) AS mean_minus_std,
           round(avg({v}) + stddev_pop({v}), 4) AS mean_plus_std,
           round((max({v}) - min({v})) * 0.005, 4) AS padding
    FROM lineitem"""


def _histogram_sql(column: str) -> str:
    return f"""
    SELECT '{column}' AS column_name, bin, round(any_value(lo) + bin * any_value(w), 4) AS bin_start,
           round(any_value(lo) + (bin + 1) * any_value(w), 4) AS bin_end, count(*) AS value_count,
           round(count(*) / (any_value(n) * any_value(w)), 10) AS density
    FROM (SELECT CAST(least(floor(({column} - lo) / w), {_BINS - 1}) AS INTEGER) AS bin, lo, w, n
          FROM lineitem,
               (SELECT min({column}) AS lo, (max({column}) - min({column})) / {_BINS} AS w,
                       count({column}) AS n FROM lineitem))
    GROUP BY bin"""


def _curve_sql(column: str) -> str:
    last = _CURVE_GRID - 1
    return f"""
    SELECT '{column}' AS column_name, point, round(lo + point * step, 4) AS grid_x,
           round(sum(weight * exp(-0.5 * pow((point - node) * step / h, 2))) * (hi - lo) / (n * h * sqrt(2 * pi())), 6) AS scaled_density
    FROM (SELECT unnest([cell, cell + 1]) AS node, unnest([1 - (place - cell), place - cell]) AS weight, lo, hi, n, h, step
          FROM (SELECT *, least(floor(place), {last - 1}) AS cell
                FROM (SELECT least((CAST({column} AS DOUBLE) - lo) / ((hi - lo) / {last}), {last}) AS place, (hi - lo) / {last} AS step,
                             lo, hi, n, std * pow(n, -0.2) AS h
                      FROM lineitem, (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi,
                                             count({column}) AS n, stddev_samp(CAST({column} AS DOUBLE)) AS std FROM lineitem)))),
         (SELECT CAST(unnest(range({_CURVE_GRID})) AS INTEGER) AS point)
    GROUP BY point, lo, hi, n, h, step"""


JOBS = {
    "density_curves": (
        density_curves_job,
        "\nUNION ALL\n".join(
            _curve_sql(c) for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_MEASURES]
        ),
    ),
    "profile_numeric": (
        profile_numeric,
        "\nUNION ALL\n".join(
            _profile_sql(c) for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *_MEASURES]
        ),
    ),
    "histogram_density": (
        histogram_density,
        "\nUNION ALL\n".join(_histogram_sql(c) for c in ["l_quantity", "l_extendedprice"]),
    ),
    "kernel_density": (
        kernel_density_job,
        f"""
        WITH stats AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, count(l_quantity) AS n FROM lineitem),
        weights AS (SELECT l_quantity AS x, count(*) AS weight FROM lineitem
                    WHERE l_quantity IS NOT NULL GROUP BY 1),
        grid AS (SELECT CAST(p AS INTEGER) AS point, lo + p * ((hi - lo) / {_GRID - 1}) AS grid_x, n
                 FROM stats, (SELECT unnest(range(0, {_GRID})) AS p))
        SELECT point, round(grid_x, 4) AS grid_x,
               round(sum(weight * exp(-0.5 * ((x - grid_x) / {_BANDWIDTH}) * ((x - grid_x) / {_BANDWIDTH}))
                         / (n * {_BANDWIDTH} * sqrt(2 * pi()))), 8) AS density
        FROM grid, weights GROUP BY point, grid_x
        """,
    ),
    "kernel_density_binned": (
        kernel_density_binned,
        f"""
        WITH stats AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
                              count(l_extendedprice) AS n,
                              stddev(l_extendedprice) * pow(count(l_extendedprice), -0.2) AS h FROM lineitem),
        weights AS (SELECT lo + (least(floor((l_extendedprice - lo) / ((hi - lo) / 200)), 199) + 0.5)
                              * ((hi - lo) / 200) AS x, count(*) AS weight FROM lineitem, stats GROUP BY 1),
        grid AS (SELECT CAST(p AS INTEGER) AS point, lo + p * ((hi - lo) / {_GRID - 1}) AS grid_x, n, h
                 FROM stats, (SELECT unnest(range(0, {_GRID})) AS p))
        SELECT point, round(grid_x, 2) AS grid_x,
               round(sum(weight * exp(-0.5 * ((x - grid_x) / h) * ((x - grid_x) / h))
                         / (n * h * sqrt(2 * pi()))), 10) AS density
        FROM grid, weights GROUP BY point, grid_x
        """,
    ),
    "dataset_header": (
        dataset_header,
        """
        WITH ends AS (SELECT min(p_partkey) AS a, max(p_partkey) AS b, min(p_size) AS c, max(p_size) AS d FROM part)
        SELECT CAST(line_no AS INTEGER) AS line_no, line FROM (
          SELECT 0 AS line_no, '@relation part' AS line
          UNION ALL SELECT 1, '@attribute p_partkey integer [' || a || ', ' || b || ']' FROM ends
          UNION ALL SELECT 2, '@attribute p_name Invalid Type'
          UNION ALL SELECT 3, '@attribute p_size integer [' || c || ', ' || d || ']' FROM ends
          UNION ALL SELECT 4, '@inputs p_partkey, p_name'
          UNION ALL SELECT 5, '@outputs p_size'
          UNION ALL SELECT 6, '@data')
        """,
    ),
    "bounded_sample": (
        bounded_sample_job,
        "SELECT l_orderkey, l_linenumber FROM lineitem "
        "WHERE left(md5('tenth' || l_orderkey || '-' || l_linenumber), 8) < '19999999'",
    ),
    "sample_replacement": (
        sample_replacement,
        """
        WITH RECURSIVE law(n, share, below) AS (
          SELECT 0, exp(-0.5), exp(-0.5)
          UNION ALL SELECT n + 1, share * 0.5 / (n + 1), below + share * 0.5 / (n + 1) FROM law WHERE n < 11),
        bounds AS (SELECT n, printf('%08x', least(CAST(floor(below * 4294967296) AS BIGINT), 4294967295)) AS bound FROM law)
        SELECT o_orderkey, CAST(n + 1 AS INTEGER) AS copy
        FROM orders JOIN bounds ON left(md5('draw' || o_orderkey), 8) >= bound
        """,
    ),
    "key_split": (
        key_split,
        "SELECT o_orderkey, CASE WHEN left(md5('split' || o_orderkey), 8) < '33333333' "
        "THEN 'small' ELSE 'large' END AS part FROM orders",
    ),
}
