"""Mixed delimiters, wrapper characters, the string function in all flavours, random text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import chop_swap
from weftline.functions.grouped import center_by_group
from weftline.functions.strings import ALPHANUMERIC, random_text
from weftline.plans.tables import table
from weftline.sinks.csv import write_parts
from weftline.sources.text import SURPLUS, read_mixed_delimiter, strip_wrappers
from weftline.workspace import new_folder


def scan_mixed_delimiter(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as ``name^|^brand^|size|^type`` lines, every file starting with the header."""
    path = new_folder(spark, "mixed")
    part = table(spark, folder, "part")
    wrapped = part.select(
        F.concat("p_name", F.lit("^")).alias("Name"),
        F.concat(F.lit("^"), "p_brand", F.lit("^")).alias("Brand"),
        F.col("p_size").cast("string").alias("Size"),
        F.concat(F.lit("^"), "p_type").alias("Type"),
    )
    write_parts(wrapped, path, header=True, sep="|")
    return read_mixed_delimiter(spark, path).drop(SURPLUS)


def strip_wrappers_job(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    wrapped = part.select(*[
        F.concat(F.lit("^"), c, F.lit("^")).alias(f"^{c}^") for c in ("p_name", "p_brand", "p_type")
    ])
    return strip_wrappers(wrapped)


def _identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """64-character identifiers, one per event."""
    return table(spark, folder, "events").select(
        "event_id", F.concat(F.md5(F.col("event_id").cast("string")), F.md5("event_type")).alias("uuid")
    )


def _swapped(function):
    def job(spark: SparkSession, folder: str) -> DataFrame:
        return _identifiers(spark, folder).select("event_id", function(F.col("uuid")).alias("swapped"))

    return job


def chop_swap_sqlexpr(spark: SparkSession, folder: str) -> DataFrame:
    return _identifiers(spark, folder).select("event_id", chop_swap.sql_expression("uuid").alias("swapped"))


def chop_swap_sqlfn(spark: SparkSession, folder: str) -> DataFrame:
    name = chop_swap.register_sql_function(spark)
    return _identifiers(spark, folder).selectExpr("event_id", f"{name}(uuid) AS swapped")


def chop_swap_registered(spark: SparkSession, folder: str) -> DataFrame:
    name = chop_swap.register_python_udf(spark)
    return _identifiers(spark, folder).selectExpr("event_id", f"{name}(uuid) AS swapped")


def grouped_pandas(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    centered = center_by_group(events, "event_type", "value", "centered")
    return centered.select("event_id", "event_type", F.round("centered", 4).alias("centered"))


def random_strings(spark: SparkSession, folder: str) -> DataFrame:
    """A random string per part, as long as the part's size; only its shape is reported."""
    made = table(spark, folder, "part").select(
        "p_partkey", random_text(F.col("p_size"), seed=7).alias("text")
    )
    return made.select(
        "p_partkey", F.length("text").alias("char_count"),
        F.rlike("text", F.lit(f"^[{ALPHANUMERIC}]*$")).alias("is_alphanumeric"),
    )


_SWAP_SQL = """
SELECT event_id, right(u, 16) || '-' || left(u, 48) AS swapped
FROM (SELECT event_id, md5(CAST(event_id AS VARCHAR)) || md5(event_type) AS u FROM events)
"""

JOBS = {
    "scan_mixed_delimiter": (
        scan_mixed_delimiter,
        'SELECT p_name AS "Name", p_brand AS "Brand", CAST(p_size AS VARCHAR) AS "Size", '
        'p_type AS "Type" FROM part',
    ),
    "strip_wrappers": (strip_wrappers_job, "SELECT p_name, p_brand, p_type FROM part"),
    "chop_swap_native": (_swapped(chop_swap.native), _SWAP_SQL),
    "chop_swap_sqlexpr": (chop_swap_sqlexpr, _SWAP_SQL),
    "chop_swap_sqlfn": (chop_swap_sqlfn, _SWAP_SQL),
    "chop_swap_pyudf": (_swapped(chop_swap.arrow_udf), _SWAP_SQL),
    "chop_swap_registered": (chop_swap_registered, _SWAP_SQL),
    "chop_swap_arrow": (_swapped(chop_swap.arrow_udf), _SWAP_SQL),
    "chop_swap_pandas": (_swapped(chop_swap.pandas_udf), _SWAP_SQL),
    "grouped_pandas": (
        grouped_pandas,
        "SELECT event_id, event_type, "
        "round(value - avg(value) OVER (PARTITION BY event_type), 4) AS centered FROM events",
    ),
    "random_strings": (
        random_strings,
        "SELECT p_partkey, p_size AS char_count, TRUE AS is_alphanumeric FROM part",
    ),
}
