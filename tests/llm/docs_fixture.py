"""Documents for the tests of this folder."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture
def make_docs(spark):
    """Documents of (doc_id, text) or (doc_id, text, source), with columns whose names clash with results."""

    def make(rows, **extra):
        schema = T.StructType([*DOCS.fields, *[T.StructField(n, T.StringType()) for n in extra]])
        filled = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None if r[1] is None else len(r[1]), *extra.values())
            for r in rows
        ]
        return spark.createDataFrame(filled, schema)

    return make
