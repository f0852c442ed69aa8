"""One string function - last 16 characters, a dash, first 48 - in every flavour Spark offers.

In order of preference: native expression, SQL expression and SQL function (all three become
the same native plan), then Arrow and pandas UDFs, then the pickled Python UDF.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the function.
TAIL = 16
HEAD = 48

SQL_TEXT = "concat(substring({0}, -16, 16), '-', substring({0}, 1, 48))"


def native(text: Column) -> Column:
    return F.concat(F.substring(text, -TAIL, TAIL), F.lit("-"), F.substring(text, 1, HEAD))


def sql_expression(column: str) -> Column:
    return F.expr(SQL_TEXT.format(f"`{column}`"))


def register_sql_function(spark: SparkSession, name: str = "chop_swap") -> str:
    """A temporary SQL function; calls are inlined into the query."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS STRING "
        f"RETURN {SQL_TEXT.format('text')}"
    )
    return name


def chop_swap(text: str | None) -> str | None:
    return None if text is None else f"{text[-TAIL:]}-{text[:HEAD]}"


python_udf = F.udf(chop_swap, T.StringType(), useArrow=False)
arrow_udf = F.udf(chop_swap, T.StringType(), useArrow=True)


@F.pandas_udf(T.StringType())
def pandas_udf(text: pd.Series) -> pd.Series:
    return text.str[-TAIL:] + "-" + text.str[:HEAD]


def register_python_udf(spark: SparkSession, name: str = "python_chop_swap") -> str:
    spark.udf.register(name, pandas_udf)
    return name


FLAVOURS = {
    "native": native,
    "arrow_udf": arrow_udf,
    "pandas_udf": pandas_udf,
    "python_udf": python_udf,
}
