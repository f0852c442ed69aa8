"""Consecutive row numbers over a global order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftline.workspace import materialize

_POSITION_BITS = 33


def number_rows(df: DataFrame, order_by: list, name: str, start: int = 0) -> DataFrame:
    """``df`` plus a bigint column numbering the rows in ``order_by`` order.

    Rows are range-sorted and written once with (range, position in range); ranges are
    then shifted by the sizes of those before them. ``order_by`` should be a total order,
    so that ranges can split ties and the numbering is repeatable.
    """
    serial = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
        .withColumns({
            "_range": F.shiftright(serial, _POSITION_BITS),
            "_position": serial.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        })
    )
    written = materialize(placed, "numbered")
    # One line per range: the window below sees as many rows as the write had tasks.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).select(
        "_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    return written.join(F.broadcast(offsets), "_range").select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_offset") + F.col("_position") + F.lit(start)).cast("bigint").alias(name),
    )
