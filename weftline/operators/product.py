"""Every combination of a few dimensions, decoded from row numbers.

The number of a combination is read as a mixed-radix numeral whose digits are the
positions of the dimensions' values; the last dimension varies fastest. The output has
every combination by definition, so its size is the product of the dimensions' sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.numbering import number_rows


def _digit(number: Column, stride: int, size: int) -> Column:
    return F.pmod(F.call_function("div", number, F.lit(stride).cast("bigint")), F.lit(size))


def combination(number: Column, dimensions: dict[str, list]) -> dict[str, Column]:
    """The values of combination ``number`` (0-based) of dimensions that the caller lists."""
    columns = {}
    stride = math.prod(len(v) for v in dimensions.values())
    for name, values in dimensions.items():
        stride //= len(values)
        columns[name] = F.get(F.array(*[F.lit(v) for v in values]), _digit(number, stride, len(values)).cast("int"))
    return columns


def product_size(dimensions: dict[str, list]) -> int:
    return math.prod(len(v) for v in dimensions.values())


def cross_product(spark: SparkSession, dimensions: dict[str, list | DataFrame]) -> DataFrame:
    """One row per combination.

    A dimension is a list, or a DataFrame whose first column's distinct values, NULL among
    them, are numbered where they lie and joined by number. Nothing goes through the driver
    but the dimensions' sizes.
    """
    listed = {name: values for name, values in dimensions.items() if isinstance(values, list)}
    tables = {}
    for name, values in dimensions.items():
        if name not in listed:
            distinct = values.select(F.col(values.columns[0]).alias(name)).distinct()
            tables[name] = number_rows(distinct, [name], f"_at_{name}")
    sizes = {name: len(listed[name]) if name in listed else tables[name].count() for name in dimensions}
    stride = math.prod(sizes.values())
    rows, columns = spark.range(stride), []
    for name, size in sizes.items():
        if not size:
            break
        stride //= size
        digit = _digit(F.col("id"), stride, size)
        if name in listed:
            rows = rows.withColumn(name, F.get(F.array(*[F.lit(v) for v in listed[name]]), digit.cast("int")))
        else:
            rows = rows.withColumn(f"_at_{name}", digit).join(tables[name], f"_at_{name}")
        columns.append(name)
    for name in [n for n in dimensions if n not in columns]:  # an empty dimension: no row, but its column
        kind = tables[name].schema[name].dataType if name in tables else "string"
        rows = rows.withColumn(name, F.lit(None).cast(kind))
    return rows.select(*dimensions)
