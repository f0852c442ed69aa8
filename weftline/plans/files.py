"""Round trips through files: scans, sinks, listings and per-row file work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions.strings import ALPHANUMERIC, pad_number, random_text
from weftline.operators.numbering import number_rows
from weftline.plans.tables import table
from weftline.sinks.clustering import compact_curve
from weftline.sinks.csv import write_indexed, write_named_parts, write_parts
from weftline.sinks.files import move_files, write_file_per_row
from weftline.sinks.manifest import compact_small, read_current
from weftline.sinks.table import OPEN_PARTITIONS, compact
from weftline.sources.files import file_name, list_files, parent_name
from weftline.sources.text import read_csv
from weftline.workspace import Storage, materialize, new_folder, open_partitions

#: Files of one folder, about: a folder is listed by one task.
FILES_PER_FOLDER = 10_000

_CUSTOMER = "c_custkey, c_name, c_nationkey, c_mktsegment"
_PART_SCHEMA = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
)
_PART_SQL = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


def scan_csv_strings(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "customer-csv")
    write_parts(table(spark, folder, "customer"), path, header=True)
    return read_csv(spark, path).withColumn("c_acctbal", F.format_string("%.2f", F.col("c_acctbal").cast("double")))


def scan_csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "customer-csv")
    write_parts(table(spark, folder, "customer"), path, header=True)
    found = read_csv(spark, path, infer=True)
    return found.select(
        F.col("c_custkey").cast("bigint"), "c_name", "c_nationkey",
        F.col("c_acctbal").cast("double"), "c_mktsegment",
    )


def scan_csv_sep(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "part-piped")
    part = table(spark, folder, "part")
    write_parts(part, path, header=True, sep="|")
    return read_csv(spark, path, schema=part.schema, sep="|")


def scan_csv_multiline(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks, quotes and separators survive a CSV round trip."""
    path = new_folder(spark, "documents-csv")
    write_parts(table(spark, folder, "documents").select("doc_id", "text"), path, header=True)
    texts = read_csv(spark, path, multiline=True)
    return texts.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("digest"),
        F.length("text").cast("bigint").alias("char_count"),
    )


def scan_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")


def sink_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "orders-parquet")
    table(spark, folder, "orders").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderpriority")


def _orders_by_status(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "orders-by-status")
    table(spark, folder, "orders").write.partitionBy("o_orderstatus").parquet(path)
    return path


def scan_parquet_glob(spark: SparkSession, folder: str) -> DataFrame:
    path = _orders_by_status(spark, folder)
    return spark.read.parquet(f"{path}/*/*.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")


def scan_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    path = _orders_by_status(spark, folder)
    return spark.read.parquet(path).where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")


def lineage_columns(spark: SparkSession, folder: str) -> DataFrame:
    path = _orders_by_status(spark, folder)
    source = F.col("_metadata.file_path")
    rows = spark.read.parquet(f"{path}/*/*.parquet").select(
        F.regexp_replace(parent_name(source), "^.*=", "").alias("category"),
        F.endswith(file_name(source), F.lit(".parquet")).alias("is_parquet"),
    )
    return rows.groupBy("category", "is_parquet").agg(F.count(F.lit(1)).alias("row_count"))


def sink_csv_parts(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "part-csv")
    write_parts(table(spark, folder, "part"), path)
    return spark.read.schema(_PART_SCHEMA).csv(path)


def sink_csv_single(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with friendly names, together one ordered CSV."""
    path = new_folder(spark, "named") + "/part"
    written = write_named_parts(table(spark, folder, "part"), path, ["p_partkey"], header=True)
    names = Storage(spark).names_in(path)
    if [n for n in names if n.endswith(".csv") and not n.startswith(".")] != [f"part-{i:05d}.csv" for i in range(written)]:
        raise AssertionError(f"unexpected names {names}")
    return read_csv(spark, path, schema=spark.createDataFrame([], _PART_SCHEMA).schema)


def sink_csv_indexed(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "indexed") + "/supplier"
    write_indexed(table(spark, folder, "supplier"), path, ["s_suppkey"])
    return read_csv(
        spark, path,
        schema="row_index bigint, s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    )


def range_generate(spark: SparkSession, folder: str) -> DataFrame:
    """The numbers from 0 below the count of orders, padded, each with the order of that place by key.

    The range follows the number of rows, not the size of the keys, so sparse keys cost nothing.
    """
    orders = table(spark, folder, "orders")
    placed = number_rows(orders.select("o_orderkey"), [F.col("o_orderkey")], "place")
    numbers = spark.range(orders.count()).select("id", pad_number(F.col("id")).alias("prefix"))
    return numbers.join(placed, F.col("id") == F.col("place")).select("id", "prefix", "o_orderkey")


def files_generate(spark: SparkSession, folder: str) -> DataFrame:
    """One file per part: padded number and random letters as its name, random content of random length.

    Files lie in folders of ``FILES_PER_FOLDER``, so that listing them is no one task's work.
    """
    root = new_folder(spark, "generated")
    numbers = spark.range(table(spark, folder, "part").count())
    suffix = random_text(F.lit(30), seed=3)
    length = (F.lit(250) + F.floor(F.rand(5) * 1_001)).cast("int")
    folder_number = F.floor(F.col("id") / FILES_PER_FOLDER)
    named = numbers.select(
        F.concat(F.lit(f"{root}/"), folder_number.cast("string"), F.lit("/"), pad_number(F.col("id")), F.lit("_"), suffix).alias("path"),
        random_text(length, seed=4).alias("content"),
    )
    written = write_file_per_row(materialize(named, "to-write"), "path", "content")
    on_disk = list_files(spark, root).select("path", "length")
    both = written.join(on_disk.withColumn("path", F.regexp_replace("path", "^file:/+", "/")).withColumnRenamed("path", "there"),
                        F.regexp_replace("path", "^file:/+", "/") == F.col("there"))
    return both.select(
        F.substring(file_name(F.col("path")), 1, 8).alias("prefix"),
        F.rlike(file_name(F.col("path")), F.lit(f"^[0-9]{{8}}_[{ALPHANUMERIC}]{{30}}$")).alias("is_named"),
        ((F.col("byte_count") == F.col("length")) & F.col("length").between(250, 1_250)).alias("is_sized"), "ok",
    )


def _document_files(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """One file per document in folders by language, of which there are as many as keep each of bounded size."""
    root, documents = new_folder(spark, "document-files"), table(spark, folder, "documents")
    folders = F.lit(1 + documents.count() // FILES_PER_FOLDER)
    named = documents.select(
        F.concat(
            F.lit(f"{root}/"), F.pmod(F.xxhash64("doc_id"), folders).cast("string"), F.lit("/"),
            "lang", F.lit("/"), pad_number(F.col("doc_id")), F.lit(".txt"),
        ).alias("path"),
        "text",
    )
    return root, write_file_per_row(named, "path", "text")


def files_write(spark: SparkSession, folder: str) -> DataFrame:
    _, written = _document_files(spark, folder)
    return written.select(
        parent_name(F.col("path")).alias("lang"), file_name(F.col("path")).alias("name"), "byte_count", "ok"
    )


def file_listing(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = _document_files(spark, folder)
    return list_files(spark, root).select("category", "name", F.col("length").alias("byte_count"))


def files_move(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = _document_files(spark, folder)
    target = new_folder(spark, "moved-files")
    moves = list_files(spark, root).select(
        "path", F.concat(F.lit(f"{target}/"), F.substring_index("path", "/", -3)).alias("destination")
    )
    results = move_files(moves).groupBy("move_result").agg(F.count(F.lit(1)).alias("file_count"))
    left = list_files(spark, target).agg(F.count(F.lit(1)).alias("arrived_count"))
    return results.select("*", left.scalar().alias("arrived_count"))


def compact_cluster(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in many small files, rewritten in time order per flag and status."""
    source, target = new_folder(spark, "scattered"), new_folder(spark, "compacted")
    keys = ["l_returnflag", "l_linestatus"]
    items = table(spark, folder, "lineitem")
    # Many small files: rows go out as they lie, cut after a few thousand.
    items.write.option("maxRecordsPerFile", 5_000).partitionBy(*keys).parquet(source)
    compacted = compact(spark, source, target, keys, "l_shipdate")
    return compacted.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("last_day"),
        F.sum("l_orderkey").alias("key_sum"),
    )


def _box_counts(rows: DataFrame) -> DataFrame:
    """Rows and keys per flag, in all and in a box of each clustering column."""
    late, dear = F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz"), F.col("l_extendedprice") > 50_000
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("l_orderkey").alias("key_sum"),
        F.count_if(late).alias("late_count"), F.count_if(dear).alias("dear_count"),
    )


_BOX_SQL = """
    SELECT l_returnflag, count(*) AS row_count, CAST(sum(l_orderkey) AS BIGINT) AS key_sum,
           count(*) FILTER (l_shipdate >= '1999-01-01') AS late_count, count(*) FILTER (l_extendedprice > 50000) AS dear_count
    FROM lineitem GROUP BY 1"""


def cluster_curve(spark: SparkSession, folder: str) -> DataFrame:
    """Line items clustered on ship date and price at once, per flag."""
    source, target = new_folder(spark, "scattered"), new_folder(spark, "curve")
    table(spark, folder, "lineitem").write.partitionBy("l_returnflag").parquet(source)
    return _box_counts(compact_curve(spark, source, target, ["l_returnflag"], ["l_shipdate", "l_extendedprice"], file_bytes=1 << 20))


def _write_mixed_sizes(items: DataFrame, location: str) -> None:
    """Older line items in one file per task and flag, the others in files of at most 2,000 rows."""
    old = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    rest = items.where(F.coalesce(~old, F.lit(True)))
    # As many tasks as the table has parts, and none sorts its rows: their memory does not grow with the table.
    with open_partitions(items.sparkSession, OPEN_PARTITIONS):
        items.where(old).write.partitionBy("l_returnflag").parquet(location)
        rest.write.mode("append").option("maxRecordsPerFile", 2_000).partitionBy("l_returnflag").parquet(location)


def compact_small_files(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in a few large and many small files, of which only the small ones are rewritten, twice over."""
    location, items = new_folder(spark, "mixed-sizes"), table(spark, folder, "lineitem")
    _write_mixed_sizes(items, location)
    for file_bytes in (1 << 19, 1 << 20):
        compact_small(spark, location, ["l_returnflag"], items.schema, file_bytes)
    return _box_counts(read_current(spark, location, items.schema))


_ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders"

JOBS = {
    "scan_csv_strings": (
        scan_csv_strings,
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, "
        "CAST(c_nationkey AS VARCHAR) AS c_nationkey, printf('%.2f', c_acctbal) AS c_acctbal, c_mktsegment FROM customer",
    ),
    "scan_csv_inferred": (scan_csv_inferred, f"SELECT {_CUSTOMER}, c_acctbal FROM customer"),
    "scan_csv_sep": (scan_csv_sep, _PART_SQL),
    "scan_csv_multiline": (
        scan_csv_multiline,
        "SELECT doc_id, md5(text) AS digest, length(text) AS char_count FROM documents",
    ),
    "scan_parquet": (scan_parquet, _ORDER_SQL),
    "sink_parquet": (sink_parquet, _ORDER_SQL),
    "scan_parquet_glob": (scan_parquet_glob, _ORDER_SQL),
    "scan_partitioned": (
        scan_partitioned, "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
    ),
    "lineage_columns": (
        lineage_columns,
        "SELECT o_orderstatus AS category, TRUE AS is_parquet, count(*) AS row_count "
        "FROM orders GROUP BY o_orderstatus",
    ),
    "sink_csv_parts": (sink_csv_parts, _PART_SQL),
    "sink_csv_single": (sink_csv_single, _PART_SQL),
    "sink_csv_indexed": (
        sink_csv_indexed,
        "SELECT row_number() OVER (ORDER BY s_suppkey) - 1 AS row_index, s_suppkey, s_name, "
        "s_nationkey, s_acctbal FROM supplier",
    ),
    "range_generate": (
        range_generate,
        """
        SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS id,
               CASE WHEN length(CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR)) >= 8
                    THEN CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR)
                    ELSE lpad(CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS VARCHAR), 8, '0') END AS prefix,
               o_orderkey
        FROM orders
        """,
    ),
    "files_generate": (
        files_generate,
        "SELECT lpad(CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS VARCHAR), 8, '0') AS prefix, "
        "TRUE AS is_named, TRUE AS is_sized, TRUE AS ok FROM part",
    ),
    "files_write": (
        files_write,
        "SELECT lang, lpad(CAST(doc_id AS VARCHAR), CAST(greatest(8, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') || '.txt' AS name, "
        "CAST(strlen(text) AS BIGINT) AS byte_count, TRUE AS ok FROM documents",
    ),
    "file_listing": (
        file_listing,
        "SELECT lang AS category, lpad(CAST(doc_id AS VARCHAR), CAST(greatest(8, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') || '.txt' AS name, "
        "CAST(strlen(text) AS BIGINT) AS byte_count FROM documents",
    ),
    "files_move": (
        files_move,
        "SELECT TRUE AS move_result, count(*) AS file_count, count(*) AS arrived_count FROM documents",
    ),
    "cluster_curve": (cluster_curve, _BOX_SQL),
    "compact_small_files": (compact_small_files, _BOX_SQL),
    "compact_cluster": (
        compact_cluster,
        "SELECT l_returnflag, l_linestatus, count(*) AS row_count, "
        "strftime(min(l_shipdate), '%Y-%m-%d') AS first_day, strftime(max(l_shipdate), '%Y-%m-%d') AS last_day, "
        "CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM lineitem GROUP BY 1, 2",
    ),
}
