"""Three differently named feeds, brought to one typed and partitioned table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.contracts import TRIP_COLUMNS, older_trips, trips
from weftline.operators.crosstab import reconcile
from weftline.operators.reconcile import differing_keys
from weftline.plans.tables import table
from weftline.sinks.csv import write_parts
from weftline.sinks.table import create_table, load_table
from weftline.sources.files import read_conformed, read_drift_report
from weftline.sources.incremental import ledger, load_new, loaded_rows, rows_aside
from weftline.sources.text import parse_timestamps
from weftline.workspace import materialize, new_folder

_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _order_stamp() -> Column:
    """Order time as text; orders of status P carry another, unreadable format."""
    return F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(
        F.date_format("o_orderdate", _FORMAT)
    )


def _feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    orders, items, events = (table(spark, folder, n) for n in ("orders", "lineitem", "events"))
    return {
        "yellow": orders.select(
            F.col("o_orderpriority").alias("vendor_name"),
            _order_stamp().alias("Trip_Pickup_DateTime"),
            F.date_format("o_orderdate", _FORMAT).alias("Trip_Dropoff_DateTime"),
            F.lit("1.0").alias("Passenger_Count"),
            F.col("o_orderstatus").alias("Payment_Type"),
            F.col("o_totalprice").alias("Fare_Amt"),
            F.col("o_totalprice").alias("Total_Amt"),
            F.col("o_orderkey").alias("Rate_Code"),
        ),
        "green": items.select(
            F.col("l_suppkey").alias(" VendorID"),
            F.col("l_shipdate").alias("lpep_pickup_datetime"),
            F.col("l_shipdate").alias("Lpep_dropoff_datetime"),
            F.col("l_linenumber").cast("bigint").alias("Passenger_count"),
            F.col("l_quantity").alias("Trip_distance"),
            F.col("l_partkey").alias("PULocationID"),
            F.col("l_extendedprice").alias("Fare_amount"),
            F.col("l_discount").alias("Tip_amount"),
            F.col("l_tax").alias("MTA_tax"),
            F.col("l_orderkey").alias("RatecodeID"),
            F.col("l_returnflag").alias("Trip_type "),
        ),
        "fhvhv": events.select(
            F.col("event_type").alias("hvfhs_license_num"),
            F.date_format("ts", _FORMAT).alias("pickup_datetime"),
            F.date_format("ts", _FORMAT).alias("request_datetime"),
            F.col("value").alias("trip_miles"),
            F.col("value").alias("base_passenger_fare"),
            F.when(F.col("event_type") != "view", F.col("value")).alias("tips"),
            F.col("value").cast("string").alias("tip_amt"),
            (F.col("value") * 100_000).alias("driver_pay"),
            F.col("event_id").alias("ratecodeid"),
            F.col("props").alias("extra_unmapped"),
        ),
    }


def _raw_files(spark: SparkSession, folder: str) -> str:
    root = new_folder(spark, "raw-trips")
    for category, feed in _feeds(spark, folder).items():
        feed.write.parquet(f"{root}/{category}")
    return root


def load_trips(spark: SparkSession, folder: str) -> tuple[str, DataFrame, str, dict[str, int]]:
    """Write the raw files and load them: (root of raw files, loaded rows, path of what was set aside, counts).

    The table's name is dropped again; its files stay as long as the run.
    """
    root, location, aside = _raw_files(spark, folder), new_folder(spark, "trips"), new_folder(spark, "trips-aside")
    name = f"weftline_trips_{uuid.uuid4().hex}"
    create_table(spark, name, trips(), location)
    try:
        counts = load_table(read_conformed(spark, root, trips()), name, trips(), aside)
        schema = spark.table(name).schema
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return root, spark.read.schema(schema).parquet(location), aside, counts


def _comparable(loaded: DataFrame) -> DataFrame:
    """All columns of the contract in plain types; of the file name its folder."""
    out = []
    for field in trips().schema.fields:
        value = F.col(field.name)
        if field.name == "filename":
            value = F.element_at(F.split(value, "/"), -2)
        elif isinstance(field.dataType, T.TimestampType):
            value = F.date_format(value, _FORMAT)
        elif isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        out.append(value.alias(field.name))
    return loaded.select(*out)


def table_conform(spark: SparkSession, folder: str) -> DataFrame:
    return _comparable(load_trips(spark, folder)[1])


def table_conform_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The older, CSV-fed form: every raw value is text."""
    root = new_folder(spark, "raw-trips-csv")
    for category, feed in _feeds(spark, folder).items():
        stamps = {c: F.date_format(f"`{c}`", _FORMAT) for c, kind in feed.dtypes if kind.startswith("timestamp")}
        write_parts(feed.withColumns(stamps), f"{root}/{category}", header=True)
    conformed = read_conformed(spark, root, older_trips(), "csv")
    return conformed.where(F.col("year").isNotNull()).groupBy("taxi_type", "year").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("passenger_count").alias("passengers"),
        F.sum("fare_amount").cast("double").alias("fares"),
        F.sum("trip_distance").cast("double").alias("distance"),
        F.count("rate_code").alias("rated_count"),
        F.count_if(F.col("_invalid") != "").alias("invalid_count"),
    )


def load_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads over growing folders, one more cut off before its commit, and one that finds nothing new."""
    root, location, contract = new_folder(spark, "raw-trips"), new_folder(spark, "trips"), trips()

    def cut() -> None:
        raise InterruptedError

    for category, feed in _feeds(spark, folder).items():
        feed.write.parquet(f"{root}/{category}")
        if category == "green":
            try:
                load_new(spark, root, location, contract, before_commit=cut)
            except InterruptedError:
                pass
        load_new(spark, root, location, contract)
    if load_new(spark, root, location, contract) is not None:
        raise AssertionError("files were loaded twice")
    batches = ledger(spark, location).groupBy(F.col("category").alias("taxi_type")).agg(F.max("batch").alias("batch"))
    loaded = loaded_rows(spark, location, contract).groupBy("taxi_type", "year").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("fare_amount").cast("double").alias("fares"),
    )
    rejected = rows_aside(spark, location, contract).where("NOT _loaded").groupBy("taxi_type", "year").agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(None).cast("double").alias("fares"),
    )
    return loaded.unionByName(rejected).join(batches, "taxi_type")


def reconcile_counts(spark: SparkSession, folder: str) -> DataFrame:
    root, loaded, aside, _ = load_trips(spark, folder)
    return reconcile({
        "source": spark.read.parquet(f"{root}/*/*.parquet"),
        "loaded": loaded,
        "rejected": spark.read.parquet(aside).where("NOT _loaded"),
    })


def reconcile_content(spark: SparkSession, folder: str) -> DataFrame:
    """``orders`` against a copy that lost its first order, has its last one twice and other prices for one customer."""
    orders = table(spark, folder, "orders")
    ends = orders.agg(F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"), F.max("o_custkey").alias("customer"))
    raised = F.when(F.col("o_custkey") == F.col("customer"), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    times = F.when(F.col("o_orderkey") == F.col("first"), 0).when(F.col("o_orderkey") == F.col("last"), 2).otherwise(1)
    copied = orders.crossJoin(F.broadcast(ends)).withColumn("o_totalprice", raised)
    copied = copied.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).select(*orders.columns)
    found = differing_keys(orders, materialize(copied, "copied-orders"), ["o_orderkey"])
    return found.withColumn("differing_columns", F.array_join("differing_columns", ","))


def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts observed while loading: rows and values that could not be converted."""
    *_, counts = load_trips(spark, folder)
    wanted = ["source", "loaded", "rejected", "invalid_pickup_datetime", "invalid_driver_pay",
              "invalid_fare_amount"]
    return spark.createDataFrame([(k, counts[k]) for k in wanted], "measure string, row_count bigint")


def drift_report(spark: SparkSession, folder: str) -> DataFrame:
    return read_drift_report(spark, _raw_files(spark, folder), trips())


def parse_datetimes(spark: SparkSession, folder: str) -> DataFrame:
    stamped = table(spark, folder, "orders").select("o_orderstatus", _order_stamp().alias("order_datetime"))
    return parse_timestamps(stamped).groupBy(
        "o_orderstatus", F.year("order_datetime").alias("year")
    ).agg(
        F.count("order_datetime").alias("parsed_count"),
        F.count_if(F.col("order_datetime").isNull()).alias("failed_count"),
    )


_LOADED_SQL = """
SELECT 'yellow' AS taxi_type, CAST(year(o_orderdate) AS INTEGER) AS year,
       CAST(NULL AS VARCHAR) AS hvfhs_license_num, CAST(NULL AS VARCHAR) AS vendor_id,
       o_orderpriority AS vendor_name, CAST(NULL AS VARCHAR) AS request_datetime,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS pickup_datetime,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dropoff_datetime,
       CAST(NULL AS VARCHAR) AS pickup_location_id, CAST(1 AS INTEGER) AS passenger_count,
       CAST(NULL AS VARCHAR) AS trip_type, o_orderstatus AS payment_type,
       CAST(o_orderkey AS VARCHAR) AS rate_code, CAST(NULL AS DOUBLE) AS trip_distance,
       CAST(CAST(o_totalprice AS DECIMAL(8,2)) AS DOUBLE) AS fare_amount, CAST(NULL AS DOUBLE) AS mta_tax,
       CAST(NULL AS DOUBLE) AS tip_amount,
       CAST(CAST(o_totalprice AS DECIMAL(8,2)) AS DOUBLE) AS total_amount, CAST(NULL AS DOUBLE) AS driver_pay
FROM orders WHERE o_orderstatus <> 'P'
UNION ALL
SELECT 'green', CAST(year(l_shipdate) AS INTEGER), NULL, CAST(l_suppkey AS VARCHAR), NULL, NULL,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'),
       CAST(l_partkey AS VARCHAR), l_linenumber, l_returnflag, NULL, CAST(l_orderkey AS VARCHAR),
       CAST(CAST(l_quantity AS DECIMAL(9,5)) AS DOUBLE), CAST(CAST(l_extendedprice AS DECIMAL(8,2)) AS DOUBLE),
       CAST(CAST(l_tax AS DECIMAL(8,2)) AS DOUBLE), CAST(CAST(l_discount AS DECIMAL(8,2)) AS DOUBLE), NULL, NULL
FROM lineitem
UNION ALL
SELECT 'fhvhv', CAST(year(ts) AS INTEGER), event_type, NULL, NULL, strftime(ts, '%Y-%m-%d %H:%M:%S'),
       strftime(ts, '%Y-%m-%d %H:%M:%S'), NULL, NULL, NULL, NULL, NULL, CAST(event_id AS VARCHAR),
       CAST(CAST(value AS DECIMAL(9,5)) AS DOUBLE), CAST(CAST(value AS DECIMAL(8,2)) AS DOUBLE), NULL,
       CAST(CAST(value AS DECIMAL(8,2)) AS DOUBLE), NULL,
       CAST(TRY_CAST(value * 100000 AS DECIMAL(8,2)) AS DOUBLE)
FROM events
"""

# feed, raw column, target, action, SQL counting the column's values.
_DRIFT = [
    ("yellow", "vendor_name", "vendor_name", "kept", "count(o_orderpriority) FROM orders"),
    ("yellow", "Trip_Pickup_DateTime", "pickup_datetime", "renamed", "count(o_orderdate) FROM orders"),
    ("yellow", "Trip_Dropoff_DateTime", "dropoff_datetime", "renamed", "count(o_orderdate) FROM orders"),
    ("yellow", "Passenger_Count", "passenger_count", "renamed", "count(*) FROM orders"),
    ("yellow", "Payment_Type", "payment_type", "renamed", "count(o_orderstatus) FROM orders"),
    ("yellow", "Fare_Amt", "fare_amount", "renamed", "count(o_totalprice) FROM orders"),
    ("yellow", "Total_Amt", "total_amount", "renamed", "count(o_totalprice) FROM orders"),
    ("yellow", "Rate_Code", "rate_code", "renamed", "count(o_orderkey) FROM orders"),
    ("green", " VendorID", "vendor_id", "renamed", "count(l_suppkey) FROM lineitem"),
    ("green", "lpep_pickup_datetime", "pickup_datetime", "renamed", "count(l_shipdate) FROM lineitem"),
    ("green", "Lpep_dropoff_datetime", "dropoff_datetime", "renamed", "count(l_shipdate) FROM lineitem"),
    ("green", "Passenger_count", "passenger_count", "renamed", "count(l_linenumber) FROM lineitem"),
    ("green", "Trip_distance", "trip_distance", "renamed", "count(l_quantity) FROM lineitem"),
    ("green", "PULocationID", "pickup_location_id", "renamed", "count(l_partkey) FROM lineitem"),
    ("green", "Fare_amount", "fare_amount", "renamed", "count(l_extendedprice) FROM lineitem"),
    ("green", "Tip_amount", "tip_amount", "renamed", "count(l_discount) FROM lineitem"),
    ("green", "MTA_tax", "mta_tax", "renamed", "count(l_tax) FROM lineitem"),
    ("green", "RatecodeID", "rate_code", "renamed", "count(l_orderkey) FROM lineitem"),
    ("green", "Trip_type ", "trip_type", "renamed", "count(l_returnflag) FROM lineitem"),
    ("fhvhv", "hvfhs_license_num", "hvfhs_license_num", "kept", "count(event_type) FROM events"),
    ("fhvhv", "pickup_datetime", "pickup_datetime", "converted", "count(ts) FROM events"),
    ("fhvhv", "request_datetime", "request_datetime", "converted", "count(ts) FROM events"),
    ("fhvhv", "trip_miles", "trip_distance", "renamed", "count(value) FROM events"),
    ("fhvhv", "base_passenger_fare", "fare_amount", "renamed", "count(value) FROM events"),
    ("fhvhv", "tip_amt", "tip_amount", "merged_first", "count(value) FROM events"),
    ("fhvhv", "tips", "tip_amount", "merged_fallback",
     "count(value) FILTER (event_type <> 'view') FROM events"),
    ("fhvhv", "driver_pay", "driver_pay", "converted", "count(value) FROM events"),
    ("fhvhv", "ratecodeid", "rate_code", "renamed", "count(event_id) FROM events"),
    ("fhvhv", "extra_unmapped", None, "skipped", "count(props) FROM events"),
]

_DRIFT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{feed}' AS feed, '{column}' AS column_name, "
    f"CAST({'NULL' if target is None else repr(target)} AS VARCHAR) AS target_name, "
    f"'{action}' AS action, {count.replace(' FROM ', ' AS value_count FROM ')}"
    for feed, column, target, action, count in _DRIFT
)

_ALL_ROWS = (
    "(SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM events)"
)
_BAD_ROWS = "(SELECT count(*) FROM orders WHERE o_orderstatus = 'P')"

def _all_columns(sql: str) -> str:
    """``sql`` with the contract's other columns, all NULL, and the folder as file name."""
    given = {
        "taxi_type", "year", "hvfhs_license_num", "vendor_id", "vendor_name", "request_datetime", "pickup_datetime",
        "dropoff_datetime", "pickup_location_id", "passenger_count", "trip_type", "payment_type", "rate_code",
        "trip_distance", "fare_amount", "mta_tax", "tip_amount", "total_amount", "driver_pay",
    }
    names = [line.split()[0] for line in TRIP_COLUMNS.strip().splitlines()]
    others = [name for name in names if name not in given | {"filename"}]
    empty = "".join(f", CAST(NULL AS VARCHAR) AS {name}" for name in others)
    return f"SELECT *, taxi_type AS filename{empty} FROM ({sql})"


JOBS = {
    "table_conform": (table_conform, _all_columns(_LOADED_SQL)),
    "table_conform_csv": (
        table_conform_csv,
        """
        SELECT 'yellow' AS taxi_type, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS row_count,
               CAST(count(*) AS BIGINT) AS passengers,
               CAST(sum(CAST(o_totalprice AS DECIMAL(8,2))) AS DOUBLE) AS fares,
               CAST(NULL AS DOUBLE) AS distance, count(*) AS rated_count, CAST(0 AS BIGINT) AS invalid_count
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY 2
        UNION ALL
        SELECT 'green', CAST(year(l_shipdate) AS INTEGER), count(*), CAST(sum(l_linenumber) AS BIGINT),
               CAST(sum(CAST(l_extendedprice AS DECIMAL(8,2))) AS DOUBLE),
               CAST(sum(CAST(l_quantity AS DECIMAL(9,5))) AS DOUBLE), count(*), CAST(0 AS BIGINT)
        FROM lineitem GROUP BY 2
        UNION ALL
        SELECT 'fhvhv', CAST(year(ts) AS INTEGER), count(*), NULL, NULL, NULL, count(event_id), CAST(0 AS BIGINT)
        FROM events GROUP BY 2
        """,
    ),
    "load_incremental": (
        load_incremental,
        """
        SELECT 'yellow' AS taxi_type, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS row_count,
               CAST(sum(CAST(o_totalprice AS DECIMAL(8,2))) AS DOUBLE) AS fares, 1 AS batch
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY 2
        UNION ALL SELECT 'yellow', NULL, count(*), NULL, 1 FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT 'green', CAST(year(l_shipdate) AS INTEGER), count(*),
               CAST(sum(CAST(l_extendedprice AS DECIMAL(8,2))) AS DOUBLE), 2 FROM lineitem GROUP BY 2
        UNION ALL
        SELECT 'fhvhv', CAST(year(ts) AS INTEGER), count(*), CAST(sum(CAST(value AS DECIMAL(8,2))) AS DOUBLE), 3
        FROM events GROUP BY 2
        """,
    ),
    "reconcile_counts": (
        reconcile_counts,
        f"SELECT 'source' AS side, {_ALL_ROWS} AS row_count "
        f"UNION ALL SELECT 'rejected', {_BAD_ROWS} UNION ALL SELECT 'loaded', {_ALL_ROWS} - {_BAD_ROWS}",
    ),
    "reconcile_content": (
        reconcile_content,
        """
        WITH ends AS (SELECT min(o_orderkey) AS f, max(o_orderkey) AS l, max(o_custkey) AS c FROM orders)
        SELECT o_orderkey, count(*) AS left_rows,
               count(*) * CASE WHEN o_orderkey = any_value(f) THEN 0 WHEN o_orderkey = any_value(l) THEN 2 ELSE 1 END AS right_rows,
               CASE WHEN o_orderkey <> any_value(f) AND o_orderkey <> any_value(l) THEN 'o_totalprice' END AS differing_columns
        FROM orders, ends GROUP BY o_orderkey
        HAVING o_orderkey = any_value(f) OR o_orderkey = any_value(l)
            OR count(*) FILTER (o_custkey = c AND o_totalprice IS NOT NULL) > 0
        """,
    ),
    "load_counts": (
        load_counts,
        f"""
        SELECT 'source' AS measure, {_ALL_ROWS} AS row_count
        UNION ALL SELECT 'loaded', {_ALL_ROWS} - {_BAD_ROWS}
        UNION ALL SELECT 'rejected', {_BAD_ROWS}
        UNION ALL SELECT 'invalid_pickup_datetime', {_BAD_ROWS}
        UNION ALL SELECT 'invalid_driver_pay',
          (SELECT count(*) FROM events
           WHERE value IS NOT NULL AND TRY_CAST(value * 100000 AS DECIMAL(8,2)) IS NULL)
        UNION ALL SELECT 'invalid_fare_amount', CAST(0 AS BIGINT)
        """,
    ),
    "drift_report": (drift_report, _DRIFT_SQL),
    "parse_datetimes": (
        parse_datetimes,
        """
        SELECT o_orderstatus,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
               count(*) FILTER (o_orderstatus <> 'P') AS parsed_count,
               count(*) FILTER (o_orderstatus = 'P') AS failed_count
        FROM orders GROUP BY 1, 2
        """,
    ),
}
