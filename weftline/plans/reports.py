"""Cross-tabs, totals, counts and existence reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.crosstab import count_matrix, rollup_counts, value_counts, with_totals
from weftline.operators.product import cross_product
from weftline.sources.files import missing_months
from weftline.plans.tables import table

STATUSES = ["F", "O", "P"]


def _orders_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus")


def summary_matrix(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders_by_year(spark, folder).select(F.col("year").cast("string"), "o_orderstatus")
    return with_totals(count_matrix(orders, "year", "o_orderstatus", STATUSES), "year")


def summary_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return rollup_counts(_orders_by_year(spark, folder), "year", "o_orderstatus", STATUSES)


_COUNTS = """
         count(*) FILTER (o_orderstatus = 'F') AS "F",
         count(*) FILTER (o_orderstatus = 'O') AS "O",
         count(*) FILTER (o_orderstatus = 'P') AS "P",
         count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) AS other,
         count(*) FILTER (o_orderstatus IS NULL) AS missing,
         count(*) AS total"""

_TOTALS = f"""
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, {_COUNTS}, CAST(0 AS INTEGER) AS sort_key FROM orders GROUP BY 1
UNION ALL
SELECT 'total', {_COUNTS}, CAST(1 AS INTEGER) FROM orders
ORDER BY sort_key, year
"""


def year_band_pivot(spark: SparkSession, folder: str) -> DataFrame:
    # A range over the stored column instead of over year(...) lets the scan skip row groups.
    band = table(spark, folder, "orders").where(
        "o_orderdate >= TIMESTAMP_NTZ '1996-01-01' AND o_orderdate < TIMESTAMP_NTZ '2000-01-01'"
    )
    years = band.select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    return count_matrix(years, "year", "o_orderstatus", STATUSES).orderBy("year")


def value_counts_desc(spark: SparkSession, folder: str) -> DataFrame:
    return value_counts(table(spark, folder, "part"), "p_size", "part_count")


def run_means(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("run_count"), F.round(F.avg("value"), 4).alias("mean_value")
    )


def view_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two named views, queried by SQL text with parameters; the names go once the query is analysed."""
    names = {name: f"weftline_{name}_{uuid.uuid4().hex}" for name in ("supplier", "nation")}
    for name, view in names.items():
        table(spark, folder, name).createTempView(view)
    try:
        return spark.sql(
            """
            SELECT n_name, count(*) AS supplier_count, count_if(s_acctbal >= :floor) AS funded_count
            FROM IDENTIFIER(:supplier) JOIN IDENTIFIER(:nation) ON s_nationkey = n_nationkey
            GROUP BY n_name
            """,
            args={"floor": 1000, **names},
        )
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)


def missing_months_job(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    present = orders.select("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    spans = orders.groupBy("o_orderpriority").agg(
        F.lit("1995-01").alias("first_month"), F.lit("2001-12").alias("last_month")
    )
    return missing_months(spans, present, "o_orderpriority")


def full_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per segment, priority and status, with a line for combinations nobody ordered."""
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders")
    keys = ["c_mktsegment", "o_orderpriority", "o_orderstatus", "c_nationkey"]
    grid = cross_product(spark, {
        keys[0]: customers.select(keys[0]),
        keys[1]: orders.select(keys[1]),
        keys[2]: orders.select(keys[2]),
        keys[3]: customers.select(keys[3]),
    })
    # Counting per customer first leaves one row per key for the join, however hot a customer is.
    by_customer = orders.groupBy("o_custkey", keys[1], keys[2]).agg(F.count(F.lit(1)).alias("n"))
    seen = (
        by_customer.join(customers, by_customer.o_custkey == customers.c_custkey)
        .groupBy(*keys).agg(F.sum("n").alias("order_count"))
    )
    same = [grid[key].eqNullSafe(seen[key]) for key in keys]
    return grid.join(seen, same, "left").select(
        *[grid[key] for key in keys], F.coalesce("order_count", F.lit(0)).cast("bigint").alias("order_count")
    )


JOBS = {
    "summary_matrix": (summary_matrix, _TOTALS),
    "summary_rollup": (summary_rollup, _TOTALS),
    "year_band_pivot": (
        year_band_pivot,
        """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, """ + _COUNTS + """
        FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY 1 ORDER BY 1
        """,
    ),
    "value_counts_desc": (
        value_counts_desc,
        "SELECT p_size, count(*) AS part_count FROM part GROUP BY p_size "
        "ORDER BY part_count DESC, p_size",
    ),
    "run_means": (
        run_means,
        "SELECT event_type, count(*) AS run_count, round(avg(value), 4) AS mean_value "
        "FROM events GROUP BY event_type",
    ),
    "view_roundtrip": (
        view_roundtrip,
        "SELECT n_name, count(*) AS supplier_count, "
        "count(*) FILTER (s_acctbal >= 1000) AS funded_count "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name",
    ),
    "missing_months": (
        missing_months_job,
        """
        WITH expected AS (
          SELECT p.o_orderpriority, strftime(m.start, '%Y-%m') AS month
          FROM (SELECT DISTINCT o_orderpriority FROM orders) p,
               (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01',
                                              INTERVAL 1 MONTH)) AS start) m)
        SELECT o_orderpriority, month FROM expected e
        WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderpriority = e.o_orderpriority
                          AND strftime(o.o_orderdate, '%Y-%m') = e.month)
        """,
    ),
    "cross_product": (
        full_grid,
        """
        WITH grid AS (
          SELECT * FROM (SELECT DISTINCT c_mktsegment FROM customer),
                        (SELECT DISTINCT o_orderpriority FROM orders),
                        (SELECT DISTINCT o_orderstatus FROM orders),
                        (SELECT DISTINCT c_nationkey FROM customer)),
        seen AS (
          SELECT c_mktsegment, o_orderpriority, o_orderstatus, c_nationkey, count(*) AS n
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
        SELECT c_mktsegment, o_orderpriority, o_orderstatus, c_nationkey,
               CAST(coalesce(n, 0) AS BIGINT) AS order_count
        FROM grid LEFT JOIN (
            SELECT c_mktsegment AS a, o_orderpriority AS b, o_orderstatus AS c, c_nationkey AS d, n FROM seen)
          ON a IS NOT DISTINCT FROM c_mktsegment AND b IS NOT DISTINCT FROM o_orderpriority
         AND c IS NOT DISTINCT FROM o_orderstatus AND d IS NOT DISTINCT FROM c_nationkey
        """,
    ),
}
