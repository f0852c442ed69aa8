"""The corpus pipeline: toxic documents go, boilerplate lines go, one of each group of near copies stays, all is packed.

Each stage takes (spark, docs, folder) and works on all that the stage before it kept; the
last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import column, free_name
from weftline.llm.jaccard import jaccard_groups
from weftline.llm.line_dedup import drop_boilerplate_lines
from weftline.llm.linking import small_batches
from weftline.llm.packing import pack
from weftline.llm.queries import BYTE_BPE
from weftline.llm.toxicity import THRESHOLD, learn, score_toxicity
from weftline.workspace import materialize

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def _docs_columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[column(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    model = learn(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    score = free_name(docs.columns, "score")
    scored = score_toxicity(docs, model, score=score, hits=free_name(docs.columns, "hits"))
    with small_batches(spark):
        return materialize(_docs_columns(scored.where(column(score) < THRESHOLD), docs), "calm")


def drop_boilerplate(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the lines that too many of their source's documents hold; n_chars follows the text."""
    kept = drop_boilerplate_lines(docs, host=F.col("source"), dropped=None)
    return kept.withColumn("n_chars", F.length("text").cast("bigint"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of similar documents, the first in (doc_id nulls last, row key), and all rows linked with none.

    Rows are told apart by keys of their own, so repeated and null ids neither lose nor keep
    other texts. Texts without words are linked with nothing; of those that repeat both id
    and text one stays.
    """
    key = free_name(docs.columns, "row_key")
    keyed = materialize(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    groups = jaccard_groups(keyed, doc_id=key, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    groups = groups.select(F.col("doc_id").alias("row"), "n_shingles", "component_id")
    rows = keyed.select(
        column(key).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit(1), "text").alias("h2"), F.col("text").isNull().alias("no_text"),
    )
    repeats = (F.col("n_shingles") == 0) & F.col("id").isNotNull()
    placed = materialize(groups.join(rows, "row").select(
        "row", "id", F.when(~repeats, F.col("component_id")).alias("component"),
        F.when(repeats, F.struct("id", "h1", "h2", "no_text")).alias("same"),
    ), "placed-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    kept = placed.groupBy("component", "same").agg(first.alias("first")).select("first.row")
    gone = materialize(placed.select("row").join(kept, "row", "left_anti").withColumnRenamed("row", key), "gone", rows=keyed.count())
    return _docs_columns(keyed.join(gone, key, "left_anti"), docs)


def pack_documents(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the packed sequences of all documents left."""
    return pack(docs, BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_jaccard_join", drop_near_copies),
    ("packing", pack_documents),
]

#: The learned model and the tokenizer have no form in SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, folder), name)
    return docs
