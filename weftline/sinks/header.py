"""Text header describing a dataset: relation, typed attributes with ranges, inputs, outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Attribute type words of the header format.
INTEGER_WORD = "integer"
REAL_WORD = "real"
OTHER_WORD = "Invalid Type"


def attribute_word(kind: T.DataType) -> str:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return INTEGER_WORD
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return REAL_WORD
    return OTHER_WORD


def header_lines(df: DataFrame, relation: str, output: str) -> DataFrame:
    """``(line_no, line)`` of the header; all ranges come from one aggregate."""
    words = {f.name: attribute_word(f.dataType) for f in df.schema.fields}
    ranged = [c for c, word in words.items() if word != OTHER_WORD]
    ends = df.agg(
        *[F.min(c).cast("string").alias(f"lo_{c}") for c in ranged],
        *[F.max(c).cast("string").alias(f"hi_{c}") for c in ranged],
    ) if ranged else df.agg(F.count(F.lit(1)).alias("rows"))
    lines = [F.lit(f"@relation {relation}")]
    for column, word in words.items():
        text = F.lit(f"@attribute {column} {word}")
        if column in ranged:
            text = F.concat(text, F.lit(" ["), F.coalesce(f"lo_{column}", F.lit("null")), F.lit(", "),
                            F.coalesce(f"hi_{column}", F.lit("null")), F.lit("]"))
        lines.append(text)
    lines.append(F.lit("@inputs " + ", ".join(c for c in df.columns if c != output)))
    lines.append(F.lit(f"@outputs {output}"))
    lines.append(F.lit("@data"))
    return ends.select(F.posexplode(F.array(*lines)).alias("line_no", "line"))


def write_header(df: DataFrame, relation: str, output: str, path: str) -> None:
    """The header as one text file; it has one line per column, so one task is enough."""
    lines = header_lines(df, relation, output)
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)
