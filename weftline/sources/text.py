"""Delimited text, including delimiters the CSV reader cannot express."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.workspace import materialize


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    infer: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """CSV with a header line. Without ``schema`` or ``infer`` every column is a string.

    Inference reads the data twice; jobs over large inputs should pass ``schema``.
    ``multiline`` keeps quoted line breaks, at the price of unsplittable files.
    """
    reader = (
        spark.read.option("header", True).option("sep", sep).option("inferSchema", infer)
        .option("multiLine", multiline).option("escape", '"')
    )
    return (reader.schema(schema) if schema else reader).csv(path)


def without_markers(line: Column, sep: str = "|", wrapper: str = "^") -> Column:
    """Drop wrapper characters that touch a separator; all others stay."""
    return F.replace(
        F.replace(line, F.lit(sep + wrapper), F.lit(sep)), F.lit(wrapper + sep), F.lit(sep)
    )


SURPLUS = "_surplus"


def read_mixed_delimiter(spark: SparkSession, path: str, sep: str = "|", wrapper: str = "^") -> DataFrame:
    """Lines whose fields are split by ``sep``, each possibly wrapped; each file's first line has its names.

    Fields are placed by the header of their own file, so files may order or choose their
    columns differently; a column that a file lacks is NULL there. Every line equal to its
    file's header is dropped, so concatenated files work too. Lines shorter than the header
    give NULLs for the missing fields; fields beyond it are kept in ``_surplus``.
    """
    unmarked = without_markers(F.col("value"), sep, wrapper).alias("line")
    # The first line of a file is the one at its start: no part of a file but that has it.
    start = F.col("_metadata.file_block_start") == 0
    lines = spark.read.text(path).select(
        unmarked, F.col("_metadata.file_path").alias("file"), start.alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    headers = materialize(
        lines.where("start").groupBy("file").agg(F.min_by("line", "place").alias("header")), "headers"
    )
    names: list[str] = []
    for row in headers.select("header").distinct().orderBy("header").collect():
        names += [name for name in row["header"].split(sep) if name not in names]
    if not names:
        raise ValueError(f"{path} is empty")
    pattern = re.escape(sep)
    fields, own = F.split("line", pattern), F.split("header", pattern)

    def field(name: str) -> Column:
        position = F.array_position(own, F.lit(name))
        return F.when(position > 0, F.get(fields, (position - 1).cast("int"))).alias(name)

    surplus = F.when(F.size(fields) > F.size(own), F.slice(fields, F.size(own) + 1, F.size(fields)))
    return lines.join(headers, "file").where("line != header").select(
        *[field(name) for name in names], surplus.alias(SURPLUS)
    )


def strip_wrappers(df: DataFrame, wrapper: str = "^") -> DataFrame:
    """Remove one wrapper character per end from every value and all from the names.

    Values become strings; column order is kept.
    """
    mark = re.escape(wrapper)
    return df.select(
        *[
            F.regexp_replace(F.col(f"`{name}`").cast("string"), f"^{mark}|{mark}$", "")
            .alias(name.replace(wrapper, ""))
            for name in df.columns
        ]
    )


def parse_timestamps(df: DataFrame, suffix: str = "datetime", fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Parse string columns whose name ends in ``suffix``; bad text becomes NULL."""
    parsed = {
        f.name: F.try_to_timestamp(F.col(f.name), F.lit(fmt))
        for f in df.schema.fields
        if f.name.endswith(suffix) and isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(parsed)
