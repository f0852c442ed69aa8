"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import licenses
from weftline.llm.exact_dedup import deduplicate
from weftline.llm.jaccard import jaccard_groups
from weftline.llm.kmeans_tree import nearest
from weftline.llm.licenses import scan_licenses
from weftline.llm.line_dedup import MIN_PAGES, RATIO, drop_boilerplate_lines, host_of
from weftline.llm.minhash import near_duplicate_groups
from weftline.llm.packing import pack
from weftline.llm.pair_index import round_trip_digests
from weftline.llm.prefix_counts import count_tokens
from weftline.llm.sharding import shard_digest
from weftline.llm.shared_lists import hard_negatives
from weftline.llm.spelling import spelling_variants
from weftline.llm.toxicity import classify

SHARDS = 8
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op2_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(_table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return count_tokens(docs, BYTE_BPE).drop("text")


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_digest(_table(spark, folder, "documents"), SHARDS)


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(_table(spark, folder, "documents"), width=3, percent=90)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    kept = drop_boilerplate_lines(with_tag_lines(pages), host=host_of(F.col("url")), text="html")
    return kept.select("page_id", "dropped_lines", F.sha2(F.col("html").cast("binary"), 256).alias("text_sha256"))


def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(spark, f"{folder}/documents.parquet")


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), BYTE_BPE)


def op9_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip_digests(_table(spark, folder, "documents").select("doc_id", "text"), BYTE_BPE)


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_minhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_duplicate_groups(_table(spark, folder, "documents"), width=4, percent=80)
    return groups.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(_table(spark, folder, "documents"))


def with_tag_lines(pages: DataFrame) -> DataFrame:
    """``pages`` with the end of every block element, and every ``<br>``, as the end of a line."""
    ends = r"(?i)(</(?:p|div|h[1-6]|li|ul|nav|footer|title|style|script|article|table|tr)>|<br ?/?>)"
    return pages.withColumn("html", F.regexp_replace("html", ends, "$1\n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    job.__name__: job
    for job in (
        op1_toxicity, op2_licenses, op3_token_counts, op4_sharding, op5_ngram_jaccard, op6_line_dedup, op7_exact_dedup,
        op8_packing, op9_bpe_round_trip, op10_nearest_neighbours, op11_hard_negatives, op12_minhash,
        op13_spelling_variants,
    )
}

_LINE_DEDUP = f"""
    WITH lined AS (
        SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host,
            string_split(regexp_replace(html,
                '(?i)(</(?:p|div|h[1-6]|li|ul|nav|footer|title|style|script|article|table|tr)>|<br ?/?>)',
                '\\1' || chr(10), 'g'), chr(10)) AS lines
        FROM pages),
    totals AS (SELECT host, count(*) AS host_pages FROM lined WHERE lines IS NOT NULL GROUP BY host),
    held AS (
        SELECT host, line, count(*) AS line_pages
        FROM (SELECT host, page_id, unnest(list_distinct([trim(l) FOR l IN lines])) AS line FROM lined)
        GROUP BY host, line),
    drops AS (
        SELECT host, list(line) AS drop_lines FROM held JOIN totals USING (host)
        WHERE line <> '' AND line_pages >= {MIN_PAGES} AND line_pages > host_pages * {RATIO} GROUP BY host),
    kept AS (
        SELECT page_id, lines, [l FOR l IN lines IF NOT list_contains(coalesce(drop_lines, []), trim(l))] AS left_lines
        FROM lined LEFT JOIN drops USING (host))
    SELECT page_id, coalesce(len(lines) - len(left_lines), 0)::INTEGER AS dropped_lines,
        sha256(array_to_string(left_lines, chr(10))) AS text_sha256
    FROM kept"""

_EXACT_DEDUP = """
    WITH plain AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS plain FROM documents)
    SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
        doc_id = min(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
    FROM plain WINDOW same AS (PARTITION BY plain)"""

_HARD_NEGATIVES = """
    WITH whole AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [floor(x::DOUBLE * 256) FOR x IN embedding] AS parts
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label,
            list_inner_product(a.parts, r.parts)::BIGINT AS score
        FROM whole a JOIN whole r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
        FROM scored WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, positive_id, negative_rank::INTEGER AS rank, negative_id, positive_score, negative_score
    FROM (
        SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
            row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS negative_rank
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
        WHERE 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score) AS p
    WHERE negative_rank <= 5"""

ORACLES: dict[str, str] = {
    "op2_licenses": licenses.oracle(),
    "op6_line_dedup": _LINE_DEDUP,
    "op7_exact_dedup": _EXACT_DEDUP,
    "op11_hard_negatives": _HARD_NEGATIVES,
}
