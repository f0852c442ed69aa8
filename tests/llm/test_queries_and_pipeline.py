"""The registered queries on the smallest tables, and the pipeline against brute force."""

import random
from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from check import connect, difference
from docs_fixture import make_docs  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.queries import ORACLES, QUERIES

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_equals_its_sql(spark, oracle, name):
    problem, rows = difference(spark, oracle, TABLES, QUERIES[name], ORACLES.get(name))
    assert problem is None and rows > 0


def test_everything_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "packing"]


def test_pipeline_stages_take_effect(spark, tmp_path):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        words = [rng.choice("bdfgk") + rng.choice("aeiou") + rng.choice("lmnrt") for _ in range(60)]
        if toxic:
            words[5] = words[20] = words[40] = "grumblotz"
        rows.append((i, "read this first\n" + " ".join(words), "en", f"s{i % 3}", 0))
        labels.append((i, 1, int(toxic)))
    near = rows[601 - 10][1].split(" ")
    near[-1] = "changed"
    rows += [(1000, " ".join(near), "en", "s9", 0), (1001, rows[592][1], "en", "s0", 0), (1002, None, None, None, None), (1003, "", "en", "s0", 0), rows[593], rows[593]]
    schema = T.StructType.fromDDL("doc_id bigint, text string, lang string, source string, n_chars bigint")
    folder = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    toxic_ids = {i for i, _, t in labels if t}
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        before, docs = {r.doc_id for r in docs.collect()}, spark.read.parquet(path)
        after = {r.doc_id for r in docs.collect()}
        if name == "toxicity":
            assert before - after == toxic_ids
        elif name == "line_dedup":
            assert before == after
            assert docs.where(F.col("text").startswith("read this first") & (F.col("source") != "s9")).count() == 0
            assert docs.where("n_chars != length(text)").count() == 0
        else:
            assert before - after == {1000, 1001}
            assert docs.where(F.col("doc_id") == rows[593][0]).count() == 1
    packed = corpus_pipeline.pack_documents(spark, docs, folder)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == after
    assert corpus_pipeline.run(spark, folder).agg(F.sum("length")).first()[0] == packed.agg(F.sum("length")).first()[0]


def test_near_copies_go_by_row_and_not_by_id(spark, make_docs):
    rng = random.Random(5)
    one, two, three, four = [" ".join(f"{rng.choice('bdfgk')}{rng.randrange(10_000)}" for _ in range(60)) for _ in range(4)]
    near = {text: text + " more" for text in (one, two, three, four)}
    docs = make_docs([
        (3, one), (5, near[one]), (5, two),  # only one text of id 5 is a copy
        (None, three), (None, near[three]), (7, near[four]), (None, four), (8, one[::-1]), (8, one[::-1] + " more"),
        (9, ""), (9, ""), (9, None), (10, ""), (None, ""), (None, ""),
    ], row_key="clash")
    out = corpus_pipeline.drop_near_copies(spark, docs, "")
    got = Counter((r.doc_id, r.text) for r in out.collect())
    thirds = {(None, three), (None, near[three])} & set(got)
    assert out.columns == docs.columns and len(thirds) == 1
    eights = {(8, one[::-1]), (8, one[::-1] + " more")} & set(got)
    assert len(eights) == 1
    assert got == Counter([(3, one), (5, two), (7, near[four]), *thirds, *eights, (9, ""), (9, None), (10, ""), (None, ""), (None, "")])
