"""CSV exports: many parts, ordered parts with friendly names, and parts with a row index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.operators.numbering import number_rows
from weftline.workspace import Storage, new_folder


def write_parts(df: DataFrame, path: str, header: bool = False, sep: str = ",") -> None:
    """One file per partition, replacing what is at ``path``."""
    (
        df.write.mode("overwrite").option("header", header).option("sep", sep).option("escape", '"')
        .csv(path)
    )


def write_named_parts(df: DataFrame, path: str, order_by: list[str], header: bool = False) -> int:
    """Globally ordered CSV parts ``<folder>/<name>-00000.csv``, ... at ``path``; returns their number.

    Rows are range-sorted, so each range is one writer and the parts in name order are the
    ordered table; with ``header`` each part has the header line. There is no single file
    and hence no bound on size. What was at ``path`` is replaced.
    """
    spark, storage = df.sparkSession, Storage(df.sparkSession)
    ordered = df.repartitionByRange(*[F.col(f"`{c}`") for c in order_by])
    stage = new_folder(spark, "named-csv")
    write_parts(ordered.sortWithinPartitions(*[F.col(f"`{c}`") for c in order_by]), stage, header)
    parts = [name for name in storage.names_in(stage) if name.startswith("part-")]
    if storage.exists(path):
        storage.remove(path)
    name = path.rstrip("/").rpartition("/")[2]
    for number, part in enumerate(parts):
        storage.move(f"{stage}/{part}", f"{path}/{name}-{number:05d}.csv")
    storage.remove(stage)
    return len(parts)


def write_indexed(df: DataFrame, path: str, order_by: list[str]) -> int:
    """Named parts with header and a leading, unnamed 0-based row index over all parts."""
    numbered = number_rows(df, [F.col(f"`{c}`") for c in order_by], "row_index")
    columns = [F.col("row_index").alias("_c0"), *[F.col(f"`{c}`") for c in df.columns]]
    return write_named_parts(numbered.select(*columns), path, ["_c0"], True)
