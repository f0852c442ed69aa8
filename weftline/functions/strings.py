"""String columns built from native expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alphabet of random names and contents.
ALPHANUMERIC = string.ascii_letters + string.digits


def pad_number(number: Column, width: int = 8) -> Column:
    """The number with zeros in front, at least ``width`` digits long; longer numbers stay whole."""
    digits = number.cast("string")
    return F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def random_text(length: Column, seed: int) -> Column:
    """``length`` random alphanumeric characters, a different string for every row.

    One code per position is drawn and looked up, so the length may vary by row.
    """
    letters = F.lit(ALPHANUMERIC)
    size = F.lit(len(ALPHANUMERIC))
    row = F.rand(seed)

    def letter(position: Column) -> Column:
        draw = F.pmod(F.xxhash64(F.lit(seed), row, position), size).cast("int")
        return F.substring(letters, draw + 1, F.lit(1))

    positions = F.when(length > 0, F.sequence(F.lit(1), length.cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return F.array_join(F.transform(positions, letter), "")


def keyed_json(key: Column, *columns: str) -> list[Column]:
    """The ``(key, value)`` pair of a message: ``value`` is the JSON of ``columns``."""
    return [
        key.cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in columns])).alias("value"),
    ]
