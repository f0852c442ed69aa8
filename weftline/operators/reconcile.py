"""Two tables compared by content: which keys differ, in which columns, and how often each side has them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.workspace import materialize

#: Slices of the key space; the list of those that differ is broadcast and has at most this many lines.
SLICES = 65_536
#: A 64-bit hash is summed in three parts, so that sums of up to 2^41 rows of a slice stay within a BIGINT.
_PART_BITS = 22

_SIDE, _SLICE = "__side", "__slice"


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hashed(fields: Sequence[T.StructField]) -> Column:
    """A 64-bit hash of the fields that also tells where the NULLs stand."""
    parts = []
    for field in fields:
        value = _quoted(field.name)
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        parts += [F.to_json(F.struct(value), {"ignoreNullFields": "false"}) if nested else value, value.isNull()]
    return F.xxhash64(*parts)


def _signed_sums(hashed: Column) -> Column:
    """Sums of the hash's parts, added for the left side and taken off for the right; NULL-free."""
    mask = F.lit((1 << _PART_BITS) - 1)
    parts = [F.shiftrightunsigned(hashed, _PART_BITS * n).bitwiseAND(mask) for n in range(3)]
    return F.array(*[F.sum(part * F.col(_SIDE)) for part in parts])


def _differs(sums: Column) -> Column:
    return F.exists(sums, lambda part: part != 0)


def differing_keys(
    left: DataFrame, right: DataFrame, key: Sequence[str], columns: str = "differing_columns", slices: int = SLICES
) -> DataFrame:
    """Keys whose rows are not the same multiset on both sides: ``(key …, left_rows, right_rows, differing_columns)``.

    Both sides have the same columns and types, in any order. Order of rows does not matter,
    repeated rows count, NULL equals NULL also in the key, and keys may stand in many rows. The key
    space is dealt into ``slices`` by hash. One pass sums the hashes of all rows per slice,
    added for the left side and taken off for the right; tables that are equal need no more
    than it. Only rows of slices whose sums are not zero are then grouped by key. Sums are built before
    rows are shuffled, so neither a hot key nor a hot slice gathers rows in one task.

    ``differing_columns`` names, in the order of ``left``, the columns whose own multisets
    differ for the key; it is NULL where the sides have different numbers of rows, and
    empty where only the combination of equal values differs. Differences are told from sums of 64-bit hashes.
    """
    if slices > SLICES:
        raise ValueError(f"at most {SLICES} slices, since the list of them is broadcast")
    fields = list(left.schema.fields)
    types = {f.name: f.dataType for f in right.schema.fields}
    if {f.name: f.dataType for f in fields} != types or len(types) != len(fields) or len(right.columns) != len(fields):
        raise ValueError("both sides need the same columns, each once and of the same type")
    missing = [name for name in key if name not in types]
    if missing or not key:
        raise ValueError(f"no such key columns: {missing}")
    clash = {_SIDE, _SLICE, "left_rows", "right_rows", columns} & set(types)
    if clash:
        raise ValueError(f"reserved column names: {sorted(clash)}")

    keyed = [f for f in fields if f.name in key]
    others = [f for f in fields if f.name not in key]
    every = [_quoted(f.name) for f in fields]
    sides = left.select(*every, F.lit(1).cast("bigint").alias(_SIDE)).unionByName(
        right.select(*every, F.lit(-1).cast("bigint").alias(_SIDE))
    ).withColumn(_SLICE, F.pmod(_hashed(keyed), F.lit(slices)).cast("int"))

    found = sides.groupBy(_SLICE).agg(F.sum(_SIDE).alias("more"), _signed_sums(_hashed(fields)).alias("sums"))
    found = materialize(found.where((F.col("more") != 0) | _differs(F.col("sums"))).select(_SLICE), "differing-slices")

    per_key = sides.join(F.broadcast(found), _SLICE, "left_semi").groupBy(*[_quoted(name) for name in key]).agg(
        F.count_if(F.col(_SIDE) == 1).alias("left_rows"), F.count_if(F.col(_SIDE) == -1).alias("right_rows"),
        _signed_sums(_hashed(fields)).alias("__all"),
        *[_signed_sums(_hashed([f])).alias(f"__sums_{n}") for n, f in enumerate(others)],
    )
    named = [F.when(_differs(F.col(f"__sums_{n}")), F.lit(f.name)) for n, f in enumerate(others)]
    listed = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    even = F.col("left_rows") == F.col("right_rows")
    return per_key.where(~even | _differs(F.col("__all"))).select(
        *[_quoted(name) for name in key], "left_rows", "right_rows", F.when(even, listed).alias(columns)
    )
