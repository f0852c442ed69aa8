"""Bring files whose schemas drift to one typed target schema."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INVALID = "_invalid"
LEFT_OUT = "_left_out"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class Contract:
    """Target schema of a table and the rules that lead to it.

    ``synonyms`` maps a cleaned (trimmed, lower-case) source name to a target name.
    ``year_of`` names the column derived from the year of a timestamp column.
    Columns declared NOT NULL in ``schema`` decide whether a row is loaded or rejected.
    """

    schema: T.StructType
    synonyms: dict[str, str]
    partition_by: tuple[str, ...] = ()
    year_of: tuple[str, str] | None = None
    datetime_format: str = "yyyy-MM-dd HH:mm:ss"

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def clean_name(name: str) -> str:
    return name.strip().lower()


def sources_by_target(columns: list[str], contract: Contract) -> dict[str, list[str]]:
    """Input columns feeding each target: the canonical name first, then map order."""
    rank = {old: i for i, old in enumerate(contract.synonyms, start=1)}
    found: dict[str, list[str]] = {}
    for column in sorted(columns, key=lambda c: rank.get(clean_name(c), 0)):
        cleaned = clean_name(column)
        found.setdefault(contract.synonyms.get(cleaned, cleaned), []).append(column)
    return found


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def typed(source: Column, have: T.DataType, want: T.DataType, datetime_format: str) -> Column:
    """``source`` as ``want``; a value that does not fit becomes NULL, never an error.

    Whole numbers are read exactly, however long; a value with a fraction does not fit.
    """
    if have == want:
        return source
    if isinstance(have, T.StringType) and isinstance(want, T.TimestampType):
        return F.try_to_timestamp(source, F.lit(datetime_format))
    if isinstance(want, _WHOLE) and isinstance(have, (T.StringType, T.DoubleType, T.FloatType, T.DecimalType)):
        exact = source.try_cast(T.DecimalType(38, 10))
        return F.when(exact == F.floor(exact), exact.try_cast(want))
    return source.try_cast(want)


def conform(df: DataFrame, contract: Contract, constants: dict[str, Column] | None = None) -> DataFrame:
    """Rename, parse, derive the year, fill, cast and reorder in one projection.

    ``constants`` supplies columns that do not come from the data, such as lineage. Two
    more columns keep what finds no place: ``_invalid`` lists the target columns whose
    value was present but could not be converted, and ``_left_out`` maps source columns to
    the text of such values, and of values that differ from the one taken for their target.
    Both are empty for good rows.
    """
    constants = constants or {}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    feeding = sources_by_target(df.columns, contract)
    # Each value is converted once, in a projection of its own; all that follows refers to the outcome.
    raw: dict[str, Column] = {}
    tried: dict[tuple[str, str], Column] = {}
    for target in contract.schema.fields:
        if target.name in constants:
            continue
        for c in feeding.get(target.name, []):
            raw[c] = F.col(f"__raw_{len(raw)}")
            tried[target.name, c] = raw[c] if kinds[c] == target.dataType else F.col(f"__tried_{len(tried)}")
    first = [quoted(c).alias(f"__raw_{i}") for i, c in enumerate(raw)]
    wanted = {f.name: f.dataType for f in contract.schema.fields}
    first += [
        typed(quoted(c), kinds[c], wanted[name], contract.datetime_format).alias(f"__tried_{i}")
        for i, (name, c) in enumerate(tried) if kinds[c] != wanted[name]
    ]
    first += [value.cast(wanted[name]).alias(f"__constant_{name}") for name, value in constants.items() if name in wanted]
    read = df.select(*first) if first else df
    converted: dict[str, Column] = {}
    doubtful: list[Column] = []
    left_out: list[Column] = []
    leaves: list[Column] = []
    entry = "struct<key: string, value: string>"
    for target in contract.schema.fields:
        if target.name in constants:
            converted[target.name] = F.col(f"__constant_{target.name}")
            continue
        inputs = feeding.get(target.name, [])
        if not inputs:
            converted[target.name] = F.lit(None).cast(target.dataType)
            continue
        tries = [tried[target.name, c] for c in inputs]
        taken = F.coalesce(*tries) if len(tries) > 1 else tries[0]
        converted[target.name] = taken
        for c, value in zip(inputs, tries):
            lost = raw[c].isNotNull() & value.isNull()
            if kinds[c] != target.dataType and not isinstance(target.dataType, T.StringType):
                doubtful.append(F.when(lost, F.lit(target.name)))
            if kinds[c] != target.dataType or len(inputs) > 1:
                # The first value that is there is the one taken, so it does not differ.
                differs = lost | (value.isNotNull() & (value != taken)) if len(inputs) > 1 else lost
                leaves.append(differs)
                pair = F.struct(F.lit(c).alias("key"), raw[c].cast("string").alias("value"))
                left_out.append(F.when(differs, pair).otherwise(F.lit(None).cast(entry)))
    if contract.year_of:
        year, stamp = contract.year_of
        converted[year] = F.year(converted[stamp]).cast(contract.schema[year].dataType)
    invalid = F.concat_ws(",", *doubtful) if doubtful else F.lit("")
    kept = F.map_from_entries(F.array().cast(f"array<{entry}>"))
    if left_out:
        # Most rows leave nothing out, and need no map made.
        kept = F.when(reduce(or_, leaves), F.map_from_entries(F.array_compact(F.array(*left_out)))).otherwise(kept)
    return read.select(
        *[converted[f.name].alias(f.name) for f in contract.schema.fields], invalid.alias(INVALID), kept.alias(LEFT_OUT)
    )


def complete(contract: Contract) -> Column:
    """True where every NOT NULL column has a value."""
    check = F.lit(True)
    for name in contract.required:
        check = check & F.col(name).isNotNull()
    return check


def loadable(conformed: DataFrame, contract: Contract) -> DataFrame:
    return conformed.where(complete(contract)).drop(INVALID, LEFT_OUT)


def rejected(conformed: DataFrame, contract: Contract) -> DataFrame:
    return conformed.where(~complete(contract))


def set_aside(conformed: DataFrame, contract: Contract) -> DataFrame:
    """All that the table does not hold: rejected rows, and loaded rows with values left out; ``_loaded`` tells which."""
    return conformed.where(~complete(contract) | (F.size(LEFT_OUT) > 0)).withColumn("_loaded", complete(contract))


def drift_report(df: DataFrame, feed: str, contract: Contract) -> DataFrame:
    """What happens to each input column, and how many values it carries.

    One aggregate counts all columns; only its single line is turned into rows.
    """
    feeding = sources_by_target(df.columns, contract)
    known = {f.name: f.dataType for f in contract.schema.fields}
    kinds = {f.name: f.dataType for f in df.schema.fields}
    verdicts = []
    for target, inputs in feeding.items():
        for position, column in enumerate(inputs):
            if target not in known:
                action = "skipped"
            elif len(inputs) > 1:
                action = "merged_first" if position == 0 else "merged_fallback"
            elif column != target:
                action = "renamed"
            elif kinds[column] != known[target]:
                action = "converted"
            else:
                action = "kept"
            verdicts.append((column, target if target in known else None, action))
    counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, (c, _, _) in enumerate(verdicts)])
    lines = F.array(
        *[
            F.struct(
                F.lit(feed).alias("feed"),
                F.lit(column).alias("column_name"),
                F.lit(target).cast("string").alias("target_name"),
                F.lit(action).alias("action"),
                F.col(f"n{i}").alias("value_count"),
            )
            for i, (column, target, action) in enumerate(verdicts)
        ]
    )
    return counts.select(F.inline(lines))
