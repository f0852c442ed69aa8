"""String indexing, text encoding of rows and comparison of two versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators.numbering import number_rows
from weftline.operators.profile import text_columns
from weftline.workspace import materialize

MISSING = "?"


def label_index(df: DataFrame, column: str) -> DataFrame:
    """``(column, <column>_index)``: labels by falling frequency, ties alphabetical, from 0.0.

    Only label counts are ordered, and by ranges, so high-cardinality columns are fine.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = number_rows(counts, [F.desc("_n"), F.asc(column)], "_rank")
    return ranked.select(column, F.col("_rank").cast("double").alias(f"{column}_index"))


def index_strings(df: DataFrame, columns: list[str] | None = None, keep: bool = False) -> DataFrame:
    """Replace each string column by ``<column>_index``.

    The label table is written once, so its size is known: Spark broadcasts it when it is small
    and otherwise splits hot labels of the large side.
    """
    columns = text_columns(df) if columns is None else columns
    out = df
    for column in columns:
        out = out.join(materialize(label_index(df, column), "labels"), column, "left")
    kept = df.columns if keep else [c for c in df.columns if c not in columns]
    return out.select(*kept, *[f"{c}_index" for c in columns])


#: Indexes of labels that were not there when the index was learned.
UNSEEN = ("keep", "null", "error")


class LabelIndex:
    """Label indexes learned once, for use on other rows.

    ``labels`` has (column_name, label, label_index): per column, labels by falling
    frequency in the rows learned from, ties alphabetical, from 0.0. NULL is no label and
    stays NULL. A label that was not there gets, as ``unseen`` says, the number after the
    last one ("keep"), NULL ("null"), or ends the job with an error ("error").
    """

    def __init__(self, labels: DataFrame, sizes: dict[str, int]):
        self.labels, self.sizes = labels, sizes

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str] | None = None) -> LabelIndex:
        columns = text_columns(df) if columns is None else columns
        parts = [
            label_index(df, c).select(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("label"), F.col(f"{c}_index").alias("label_index"))
            for c in columns
        ]
        if not parts:
            raise ValueError("no column to index")
        labels = parts[0]
        for part in parts[1:]:
            labels = labels.unionByName(part)
        return cls._counted(materialize(labels, "label-index"), columns)

    @classmethod
    def _counted(cls, labels: DataFrame, columns: list[str] | None = None) -> LabelIndex:
        counts = {r["column_name"]: r["count"] for r in labels.groupBy("column_name").count().collect()}  # a line per column
        return cls(labels, {c: counts.get(c, 0) for c in columns or counts})

    def save(self, path: str) -> None:
        """Write the index below ``path``, which must not exist."""
        self.labels.write.partitionBy("column_name").parquet(f"{path}/labels")
        spark = self.labels.sparkSession
        spark.createDataFrame(list(self.sizes.items()), "column_name string, labels bigint").coalesce(1).write.parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark, path: str) -> LabelIndex:
        sizes = {r["column_name"]: r["labels"] for r in spark.read.parquet(f"{path}/columns").collect()}
        schema = "label string, label_index double, column_name string"
        empty = spark.createDataFrame([], schema)
        labels = spark.read.schema(schema).parquet(f"{path}/labels") if any(sizes.values()) else empty
        return cls(labels, sizes)

    def transform(self, df: DataFrame, unseen: str = "keep", keep: bool = False) -> DataFrame:
        """``df`` with ``<column>_index`` in place of each indexed column, or beside it."""
        if unseen not in UNSEEN:
            raise ValueError(f"unseen is one of {UNSEEN}, not {unseen!r}")
        out = df
        for column, size in self.sizes.items():
            own = self.labels.where(F.col("column_name") == column).select(
                F.col("label").alias("_label"), F.col("label_index").alias(f"{column}_index")
            )
            out = out.join(own, F.col(column).cast("string") == F.col("_label"), "left").drop("_label")
            strange = F.col(column).isNotNull() & F.col(f"{column}_index").isNull()
            if unseen == "keep":
                found = F.when(strange, F.lit(float(size))).otherwise(F.col(f"{column}_index"))
            elif unseen == "error":
                message = F.concat(F.lit(f"label of {column} was not there when the index was learned: "), F.col(column).cast("string"))
                found = F.when(strange, F.raise_error(message).cast("double")).otherwise(F.col(f"{column}_index"))
            else:
                found = F.col(f"{column}_index")
            out = out.withColumn(f"{column}_index", found)
        kept = df.columns if keep else [c for c in df.columns if c not in self.sizes]
        return out.select(*kept, *[f"{c}_index" for c in self.sizes])


# Escapes of the row text: no field holds a bare comma, and a field that is just the marker is told from NULL.
_ESCAPES = (("\\", "\\\\"), ("\0", "\\0"), (",", "\\c"))


def encode_row(columns: list[str]) -> Column:
    """All fields as comma-joined text, NULL as ``?``; commas and backslashes in fields are escaped."""

    def field(name: str) -> Column:
        text = F.col(name).cast("string")
        for plain, escaped in _ESCAPES:
            text = F.replace(text, F.lit(plain), F.lit(escaped))
        return F.coalesce(F.when(text == MISSING, F.lit("\\" + MISSING)).otherwise(text), F.lit(MISSING))

    return F.concat_ws(",", *[field(c) for c in columns])


def decode_array(values: Column, fields: dict[str, str]) -> list[Column]:
    """Typed columns from the comma-split fields of a row text; ``?`` becomes NULL, escapes what they stand for."""

    def field(position: int) -> Column:
        text = F.nullif(F.element_at(values, F.lit(position)), F.lit(MISSING))
        text = F.replace(text, F.lit("\\\\"), F.lit("\0"))  # a bare zero character cannot occur in the text
        for plain, escaped in ((MISSING, "\\" + MISSING), (",", "\\c")):
            text = F.replace(text, F.lit(escaped), F.lit(plain))
        # What is left of "\0" escapes is a zero character, what is now a zero character was a backslash.
        parts = F.split(text, "\\\\0", -1)
        return F.array_join(F.transform(parts, lambda part: F.replace(part, F.lit("\0"), F.lit("\\"))), "\0")

    return [field(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields.items(), start=1)]


def null_flag_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).isNull().alias(f"{column}_is_null")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def compare_imputed(original: DataFrame, imputed: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Rows whose ``column`` was NULL in ``original``, next to their imputed value."""
    condition = [F.col(f"o.{k}") == F.col(f"i.{k}") for k in keys]
    return (
        original.alias("o").where(F.col(f"o.{column}").isNull())
        .join(imputed.alias("i"), condition, "inner")
        .select(*[F.col(f"o.{k}").alias(k) for k in keys], F.col(f"i.{column}").alias(f"imputed_{column}"))
    )
