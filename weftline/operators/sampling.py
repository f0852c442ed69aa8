"""Samples and splits; the key-based forms give the same rows on every run and cluster."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Mean number of copies per row up to which the law is written out, one comparison per number of copies.
LARGEST_MEAN = 100
_HASH_DIGITS = 8


def key_below(key: Column, fraction: float, salt: str = "") -> Column:
    """True for a repeatable ``fraction`` of the keys, chosen by their MD5 value."""
    bound = format(min(int(fraction * 16**_HASH_DIGITS), 16**_HASH_DIGITS - 1), f"0{_HASH_DIGITS}x")
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return F.left(digest, F.lit(_HASH_DIGITS)) < F.lit(bound)


def key_sample(df: DataFrame, key: Column, fraction: float, salt: str = "") -> DataFrame:
    """The rows of a repeatable ``fraction`` of the keys; rows with a NULL key are never among them."""
    return df.where(key_below(key, fraction, salt))


def key_sample_with_replacement(
    df: DataFrame, key: Column, fraction: float, copy: str = "copy", salt: str = ""
) -> DataFrame:
    """A repeatable sample in which a row may come several times, numbered from 1 in ``copy``.

    The number of copies of a row follows a Poisson law with mean ``fraction``, as drawing
    with replacement from many rows does; it is read from the MD5 of the key against the
    law's cumulative shares, up to a rest of less than 2^-32 of the rows. Means of more than
    ``LARGEST_MEAN`` are refused.
    """
    if not 0 <= fraction <= LARGEST_MEAN:
        raise ValueError(f"the mean number of copies must be from 0 to {LARGEST_MEAN}")
    share, below, bounds = math.exp(-fraction), 0.0, []
    while below < 1 - 2**-32:
        below += share
        bounds.append(below)
        share *= fraction / len(bounds)
    copies = sum((~key_below(key, bound, salt)).cast("int") for bound in bounds)
    drawn = df.withColumn(copy, F.explode(F.sequence(F.lit(0), F.coalesce(copies, F.lit(0)))))
    return drawn.where(F.col(copy) > 0)


def mask_column(df: DataFrame, column: str, chosen: Column) -> DataFrame:
    """Set ``column`` to NULL in the chosen rows; the others and the row count stay.

    The split, the blanking and the union of a two-way random split are one projection here,
    so the input is read once.
    """
    blank = F.when(~chosen, F.col(column))
    return df.withColumn(column, blank)


def split_by_key(df: DataFrame, key: Column, fraction: float, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are ``df``: the rest, and about ``fraction`` of the keys."""
    chosen = F.coalesce(key_below(key, fraction, salt), F.lit(False))
    return df.where(~chosen), df.where(chosen)
