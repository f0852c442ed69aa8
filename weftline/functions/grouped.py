"""pandas work per group that never needs a whole group in one task."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.workspace import materialize


@F.pandas_udf(T.DoubleType())
def difference(value: pd.Series, base: pd.Series) -> pd.Series:
    return value - base


def center_by_group(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``value`` minus its group's mean.

    Each task reduces its own batches with pandas, so a group of any size crosses the network
    as one line per batch; the means then come back by an ordinary join.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grouped = batch.groupby(key, dropna=False)[value]
            reduced = pd.DataFrame({"total": grouped.sum(), "n": grouped.count()}).reset_index()
            # Plain objects: a key column with a missing value may have become an Arrow-backed one.
            reduced[key] = pd.Series([None if pd.isna(k) else k for k in reduced[key]], dtype=object)
            yield reduced

    sums = df.select(key, value).mapInPandas(partial, f"`{key}` {kinds[key]}, total double, n bigint")
    means = sums.groupBy(key).agg((F.sum("total") / F.sum("n")).alias("_mean"))
    # Once written, its size is known: Spark broadcasts it if small and leaves ``df`` unshuffled.
    means = materialize(means, "group-means")
    same = df[key].eqNullSafe(means[key])
    return df.join(means, same, "left").select(df["*"], difference(df[value], F.col("_mean")).alias(name))
