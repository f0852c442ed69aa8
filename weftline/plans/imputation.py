"""String indexing, masking, row text, and nearest-neighbour imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.features import (
    LabelIndex, compare_imputed, decode_array, encode_row, index_strings, label_index, null_flag_counts,
)
from weftline.operators.knn import hvdm_features, impute
from weftline.operators.sampling import key_below, mask_column
from weftline.plans.tables import table
from weftline.workspace import new_folder

_SHARE = 0.2
_TEXT = ["c_custkey", "c_nationkey", "c_mktsegment"]


def _masked_customers(spark: SparkSession, folder: str, column: str = "c_acctbal") -> DataFrame:
    """Customers; for a repeatable fifth of them ``column`` is missing."""
    return mask_column(table(spark, folder, "customer"), column, key_below(F.col("c_custkey"), _SHARE))


def string_index(spark: SparkSession, folder: str) -> DataFrame:
    indexed = index_strings(table(spark, folder, "customer"), ["c_mktsegment"])
    return indexed.select("c_custkey", "c_nationkey", "c_mktsegment_index")


def index_fitted(spark: SparkSession, folder: str) -> DataFrame:
    """Customers' nations and segments by an index learned from every second nation, saved and read again."""
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left"
    ).select("c_custkey", "c_nationkey", "n_name", "c_mktsegment")
    path = new_folder(spark, "learned-index")
    LabelIndex.fit(customers.where(F.col("c_nationkey") % 2 == 0), ["n_name", "c_mktsegment"]).save(path)
    return LabelIndex.load(spark, path).transform(customers.drop("c_nationkey"))


def label_order(spark: SparkSession, folder: str) -> DataFrame:
    return label_index(table(spark, folder, "part"), "p_name")


def mask_split_union(spark: SparkSession, folder: str) -> DataFrame:
    masked = _masked_customers(spark, folder)
    return masked.select("c_custkey", "c_nationkey", "c_acctbal").orderBy("c_nationkey", "c_custkey")


def null_flags(spark: SparkSession, folder: str) -> DataFrame:
    return null_flag_counts(_masked_customers(spark, folder), "c_acctbal")


def encode_row_text(spark: SparkSession, folder: str) -> DataFrame:
    masked = _masked_customers(spark, folder, "c_mktsegment")
    return masked.select("c_custkey", encode_row(_TEXT).alias("line"))


def decode_array_row(spark: SparkSession, folder: str) -> DataFrame:
    lines = encode_row_text(spark, folder).select(F.split("line", ",").alias("fields"))
    kinds = {"c_custkey": "bigint", "c_nationkey": "int", "c_mktsegment": "string"}
    return lines.select(*decode_array(F.col("fields"), kinds))


def _indexed_masked(spark: SparkSession, folder: str) -> DataFrame:
    return index_strings(_masked_customers(spark, folder), ["c_mktsegment"], keep=True)


def _rounded(imputed: DataFrame) -> DataFrame:
    return imputed.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"))


_CUSTOMER_FEATURES = ["c_nationkey", "c_mktsegment_index"]


def knn_impute_global(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(impute(_indexed_masked(spark, folder), "c_custkey", "c_acctbal", _CUSTOMER_FEATURES))


def knn_impute_local(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbours from the customer's own hash block only."""
    block = F.left(F.md5(F.concat(F.lit("block"), F.col("c_custkey").cast("string"))), F.lit(1))
    customers = _indexed_masked(spark, folder)
    return _rounded(impute(customers, "c_custkey", "c_acctbal", _CUSTOMER_FEATURES, block=block))


def knn_impute_manhattan(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of a fifth of the orders from orders of nearby days and customers."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.datediff("o_orderdate", F.lit("1970-01-01")).alias("order_day"),
        "o_totalprice",
    )
    masked = mask_column(orders, "o_totalprice", key_below(F.col("o_orderkey"), _SHARE))
    imputed = impute(masked, "o_orderkey", "o_totalprice", ["order_day", "o_custkey"], metric="manhattan")
    return imputed.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


def knn_impute_nominal(spark: SparkSession, folder: str) -> DataFrame:
    """The most frequent segment among the neighbours; a tenth of the balances is unknown too."""
    masked = _masked_customers(spark, folder, "c_mktsegment")
    masked = mask_column(masked, "c_acctbal", key_below(F.col("c_custkey"), 0.1, "balance"))
    return impute(masked, "c_custkey", "c_mktsegment", ["c_nationkey", "c_acctbal"]).select(
        "c_custkey", "c_mktsegment"
    )


def knn_impute_hvdm(spark: SparkSession, folder: str) -> DataFrame:
    """Order prices by date and customer as numbers, priority as a nominal value judged by status."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey",
        F.datediff("o_orderdate", F.lit("1970-01-01")).cast("double").alias("order_day"), "o_totalprice",
    )
    masked = mask_column(orders, "o_totalprice", key_below(F.col("o_orderkey"), _SHARE))
    ready, names = hvdm_features(masked, ["order_day", "o_custkey"], ["o_orderpriority"], "o_orderstatus")
    imputed = impute(ready, "o_orderkey", "o_totalprice", names, scale=False)
    return imputed.select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


def impute_compare(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["c_custkey", "c_nationkey", "c_mktsegment", "c_name"]
    masked = _indexed_masked(spark, folder)
    imputed = impute(masked, "c_custkey", "c_acctbal", _CUSTOMER_FEATURES)
    both = compare_imputed(masked, imputed, keys, "c_acctbal")
    return both.select(*keys, F.round("imputed_c_acctbal", 4).alias("imputed_c_acctbal"))


def impute_join(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of both versions joined on keys that repeat: rows, pairs, and incomplete ones among them."""
    keys = ["c_nationkey", "c_mktsegment"]
    masked = _indexed_masked(spark, folder).select(*keys, "c_acctbal")
    imputed = impute(_indexed_masked(spark, folder), "c_custkey", "c_acctbal", _CUSTOMER_FEATURES).select(*keys)
    # The number of pairs follows from the counts per key; the pairs themselves need not be made.
    left = masked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("c_acctbal").isNull()).alias("incomplete")
    )
    right = imputed.groupBy(*keys).agg(F.count(F.lit(1)).alias("others"))
    return left.join(right, keys).agg(
        F.sum("rows").alias("row_count"), F.sum(F.col("rows") * F.col("others")).alias("pair_count"),
        F.sum(F.col("incomplete") * F.col("others")).alias("incomplete_pair_count"),
    )


def imputed_distribution(spark: SparkSession, folder: str) -> DataFrame:
    """How often each value was imputed, in order of the values."""
    values = impute_compare(spark, folder).select(F.round("imputed_c_acctbal", 2).alias("imputed"))
    return values.groupBy("imputed").agg(F.count(F.lit(1)).alias("row_count")).orderBy("imputed")


_MASK = "left(md5(CAST(c_custkey AS VARCHAR)), 8) < '33333333'"

_INDEX_SQL = """
labels AS (SELECT c_mktsegment AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1
                  AS DOUBLE) AS idx FROM customer GROUP BY c_mktsegment)"""


def _customer_knn_sql(block: str, final: str) -> str:
    return f"""
    WITH {_INDEX_SQL},
    base AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment, idx, {block} AS block,
                    CASE WHEN NOT ({_MASK}) THEN c_acctbal END AS target
             FROM customer JOIN labels ON c_mktsegment = label),
    ends AS (SELECT min(CAST(c_nationkey AS DOUBLE)) AS a, max(CAST(c_nationkey AS DOUBLE)) AS b,
                    min(idx) AS c, max(idx) AS d FROM base),
    scaled AS (SELECT base.*, (CAST(c_nationkey AS DOUBLE) - a) / (b - a) AS x, (idx - c) / (d - c) AS y
               FROM base, ends),
    pairs AS (SELECT p.c_custkey AS probe, q.target,
                     row_number() OVER (PARTITION BY p.c_custkey ORDER BY
                       (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y), q.c_custkey) AS rank
              FROM scaled p JOIN scaled q ON p.block = q.block
              WHERE p.target IS NULL AND q.target IS NOT NULL),
    found AS (SELECT probe, avg(target) AS value FROM pairs WHERE rank <= 3 GROUP BY probe)
    {final}"""


_FILLED = (
    "SELECT c_custkey, round(coalesce(target, value), 4) AS c_acctbal "
    "FROM base LEFT JOIN found ON c_custkey = probe"
)

_INDEX_FITTED_SQL = """
    WITH learned AS (SELECT c_mktsegment, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey % 2 = 0),
    segments AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS place
                 FROM learned WHERE c_mktsegment IS NOT NULL GROUP BY 1),
    nations AS (SELECT n_name, row_number() OVER (ORDER BY count(*) DESC, n_name) - 1 AS place FROM learned WHERE n_name IS NOT NULL GROUP BY 1)
    SELECT c_custkey,
           CASE WHEN n_name IS NOT NULL THEN CAST(coalesce(n.place, (SELECT count(*) FROM nations)) AS DOUBLE) END AS n_name_index,
           CASE WHEN c_mktsegment IS NOT NULL THEN CAST(coalesce(s.place, (SELECT count(*) FROM segments)) AS DOUBLE) END AS c_mktsegment_index
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN nations n USING (n_name) LEFT JOIN segments s USING (c_mktsegment)"""

JOBS = {
    "index_fitted": (index_fitted, _INDEX_FITTED_SQL),
    "string_index": (
        string_index,
        f"WITH {_INDEX_SQL} SELECT c_custkey, c_nationkey, idx AS c_mktsegment_index "
        "FROM customer JOIN labels ON c_mktsegment = label",
    ),
    "label_order": (
        label_order,
        "SELECT p_name, CAST(row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS DOUBLE) "
        "AS p_name_index FROM part GROUP BY p_name",
    ),
    "mask_split_union": (
        mask_split_union,
        f"SELECT c_custkey, c_nationkey, CASE WHEN NOT ({_MASK}) THEN c_acctbal END AS c_acctbal "
        "FROM customer ORDER BY c_nationkey, c_custkey",
    ),
    "null_flag_counts": (
        null_flags,
        f"SELECT ({_MASK} OR c_acctbal IS NULL) AS c_acctbal_is_null, count(*) AS row_count "
        "FROM customer GROUP BY 1",
    ),
    "encode_row_text": (
        encode_row_text,
        f"SELECT c_custkey, concat_ws(',', c_custkey, c_nationkey, "
        f"CASE WHEN {_MASK} THEN '?' ELSE c_mktsegment END) AS line FROM customer",
    ),
    "decode_array_row": (
        decode_array_row,
        f"SELECT c_custkey, c_nationkey, CASE WHEN NOT ({_MASK}) THEN c_mktsegment END AS c_mktsegment "
        "FROM customer",
    ),
    "knn_impute_global": (knn_impute_global, _customer_knn_sql("1", _FILLED)),
    "knn_impute_local": (
        knn_impute_local, _customer_knn_sql("left(md5('block' || c_custkey), 1)", _FILLED),
    ),
    "knn_impute_manhattan": (
        knn_impute_manhattan,
        """
        WITH base AS (SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS s,
                             CAST(o_custkey AS DOUBLE) AS t,
                             CASE WHEN NOT (left(md5(CAST(o_orderkey AS VARCHAR)), 8) < '33333333')
                                  THEN o_totalprice END AS target FROM orders),
        ends AS (SELECT min(s) AS a, max(s) AS b, min(t) AS c, max(t) AS d FROM base),
        scaled AS (SELECT base.*, (s - a) / (b - a) AS x, (t - c) / (d - c) AS y FROM base, ends),
        pairs AS (SELECT p.o_orderkey AS probe, q.target,
                         row_number() OVER (PARTITION BY p.o_orderkey
                           ORDER BY abs(p.x - q.x) + abs(p.y - q.y), q.o_orderkey) AS rank
                  FROM scaled p, scaled q WHERE p.target IS NULL AND q.target IS NOT NULL),
        found AS (SELECT probe, avg(target) AS value FROM pairs WHERE rank <= 3 GROUP BY probe)
        SELECT o_orderkey, round(coalesce(target, value), 4) AS o_totalprice
        FROM base LEFT JOIN found ON o_orderkey = probe
        """,
    ),
    "knn_impute_nominal": (
        knn_impute_nominal,
        f"""
        WITH base AS (SELECT c_custkey, CAST(c_nationkey AS DOUBLE) AS s,
                             CASE WHEN NOT (left(md5('balance' || c_custkey), 8) < '19999999')
                                  THEN c_acctbal END AS t,
                             CASE WHEN NOT ({_MASK}) THEN c_mktsegment END AS target FROM customer),
        ends AS (SELECT min(s) AS a, max(s) AS b, min(t) AS c, max(t) AS d FROM base),
        scaled AS (SELECT base.*, (s - a) / (b - a) AS x, (t - c) / (d - c) AS y FROM base, ends),
        pairs AS (SELECT p.c_custkey AS probe, q.target,
                         row_number() OVER (PARTITION BY p.c_custkey ORDER BY
                           CASE WHEN p.y IS NULL OR q.y IS NULL THEN (p.x - q.x) * (p.x - q.x) * 2.0
                                ELSE (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) END,
                           q.c_custkey) AS rank
                  FROM scaled p, scaled q WHERE p.target IS NULL AND q.target IS NOT NULL),
        votes AS (SELECT probe, target, row_number() OVER (PARTITION BY probe ORDER BY count(*) DESC, target) AS r
                  FROM pairs WHERE rank <= 3 GROUP BY probe, target)
        SELECT c_custkey, coalesce(base.target, votes.target) AS c_mktsegment
        FROM base LEFT JOIN votes ON c_custkey = probe AND r = 1
        """,
    ),
    "knn_impute_hvdm": (
        knn_impute_hvdm,
        """
        WITH base AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
                             CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS s,
                             CAST(o_custkey AS DOUBLE) AS t,
                             CASE WHEN NOT (left(md5(CAST(o_orderkey AS VARCHAR)), 8) < '33333333')
                                  THEN o_totalprice END AS target FROM orders),
        spread AS (SELECT 4 * round(stddev_pop(s), 6) AS a, 4 * round(stddev_pop(t), 6) AS b FROM base),
        shares AS (SELECT o_orderpriority AS value,
                          floor(round(count(*) FILTER (o_orderstatus = 'F') / count(*)::DOUBLE, 6) * 1048576.0 + 0.5) AS f,
                          floor(round(count(*) FILTER (o_orderstatus = 'O') / count(*)::DOUBLE, 6) * 1048576.0 + 0.5) AS o,
                          floor(round(count(*) FILTER (o_orderstatus = 'P') / count(*)::DOUBLE, 6) * 1048576.0 + 0.5) AS p
                   FROM base GROUP BY 1),
        scaled AS (SELECT base.*, floor(s / a * 1048576.0 + 0.5) AS x, floor(t / b * 1048576.0 + 0.5) AS y, f, o, p
                   FROM base, spread, shares WHERE o_orderpriority = value),
        pairs AS (SELECT l.o_orderkey AS probe, r.target,
                         row_number() OVER (PARTITION BY l.o_orderkey ORDER BY
                           (l.x - r.x) * (l.x - r.x) + (l.y - r.y) * (l.y - r.y) + (l.f - r.f) * (l.f - r.f)
                           + (l.o - r.o) * (l.o - r.o) + (l.p - r.p) * (l.p - r.p), r.o_orderkey) AS rank
                  FROM scaled l, scaled r WHERE l.target IS NULL AND r.target IS NOT NULL),
        found AS (SELECT probe, avg(target) AS value FROM pairs WHERE rank <= 3 GROUP BY probe)
        SELECT o_orderkey, round(coalesce(target, value), 4) AS o_totalprice
        FROM base LEFT JOIN found ON o_orderkey = probe
        """,
    ),
    "impute_join": (
        impute_join,
        f"""
        SELECT count(DISTINCT a.c_custkey) AS row_count, count(*) AS pair_count,
               count(*) FILTER (a.c_acctbal IS NULL OR left(md5(CAST(a.c_custkey AS VARCHAR)), 8) < '33333333')
                 AS incomplete_pair_count
        FROM customer a JOIN customer b USING (c_nationkey, c_mktsegment)
        """,
    ),
    "imputed_distribution": (
        imputed_distribution,
        _customer_knn_sql(
            "1",
            "SELECT round(round(value, 4), 2) AS imputed, count(*) AS row_count "
            "FROM base JOIN found ON c_custkey = probe GROUP BY 1 ORDER BY 1",
        ),
    ),
    "impute_compare": (
        impute_compare,
        _customer_knn_sql(
            "1",
            "SELECT c_custkey, c_nationkey, c_mktsegment, c_name, round(value, 4) AS imputed_c_acctbal "
            "FROM base JOIN found ON c_custkey = probe",
        ),
    ),
}
