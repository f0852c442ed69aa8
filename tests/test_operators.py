"""Profiles, numbering, products, samples, streams and plan shapes."""

import math
import os

import numpy as np
import pytest
from conftest import TABLES
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.crosstab import count_matrix, long_counts, rollup_counts, value_counts, with_totals
from weftline.operators.features import decode_array, encode_row, index_strings
from weftline.operators.numbering import number_rows
from weftline.operators.product import cross_product
from weftline.operators.profile import histogram, kernel_density, profile
from weftline.operators.sampling import (
    key_below, key_sample, key_sample_with_replacement, mask_column, split_by_key,
)
from weftline.streaming.messages import (
    MESSAGE_SCHEMA, SALES_DIMENSIONS, file_stream, kafka_options, progress_lines, random_sales_messages,
    sales_stream, start_messages, write_messages,
)
from weftline.workspace import new_folder


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_matrix_total_is_the_row_count(spark):
    rows = [(2001, "a"), (2001, "b"), (2002, "a"), (2002, "a"), (2002, "z"), (2001, None), (None, "b")]
    df = spark.createDataFrame(rows, "year int, kind string")
    matrix = with_totals(count_matrix(df, "year", "kind", ["a", "b"]), "year").collect()
    assert [tuple(r) for r in matrix] == [
        (None, 0, 1, 0, 0, 1, 0), ("2001", 1, 1, 0, 1, 3, 0), ("2002", 2, 0, 1, 0, 3, 0), ("total", 3, 2, 1, 1, 7, 1)]
    assert [tuple(r) for r in rollup_counts(df, "year", "kind", ["a", "b"]).collect()] == [tuple(r) for r in matrix]
    long = {(r.year, r.kind): r["count"] for r in long_counts(df, "year", "kind").collect()}
    assert sum(long.values()) == 7 and long[2001, None] == 1


def test_product_keeps_null_keys_and_empty_dimensions(spark):
    values = spark.createDataFrame([("x",), (None,), ("x",)], "v string")
    rows = cross_product(spark, {"v": values, "n": [1, 2]}).collect()
    assert sorted(map(str, rows)) == sorted(map(str, [Row(v=v, n=n) for v in ("x", None) for n in (1, 2)]))
    none = cross_product(spark, {"v": values.where("false"), "n": [1, 2]})
    assert none.columns == ["v", "n"] and none.count() == 0


def test_value_counts_gives_all_unless_limited(spark):
    df = spark.range(100).select((F.col("id") % 40).alias("v"))
    assert value_counts(df, "v", "n").count() == 40
    assert [r.v for r in value_counts(df, "v", "n", limit=2).collect()] == [0, 1]


def test_profile_and_histogram_follow_numpy(spark):
    values = np.random.default_rng(0).normal(10, 3, 2000)
    df = spark.createDataFrame([(float(v), 7) for v in values], "x double, same int")
    line = {r.column_name: r for r in profile(df).collect()}
    assert line["x"]["std"] == pytest.approx(np.std(values))
    assert line["x"]["mean"] == pytest.approx(np.mean(values))
    bars = {r.bin: r for r in histogram(df, ["x"], 10).collect()}
    counts, edges = np.histogram(values, 10)
    assert [bars[i].value_count if i in bars else 0 for i in range(10)] == list(counts)
    assert sum(r.density * (edges[1] - edges[0]) for r in bars.values()) == pytest.approx(1)
    constant = histogram(df, ["same"]).collect()
    assert [(r.bin, r.value_count, r.density) for r in constant] == [(0, 2000, None)]
    assert sum(r.value_count for r in histogram(df, ["x"]).collect()) == 2000


def test_density_exact_and_binned_agree(spark):
    values = np.random.default_rng(0).normal(0, 1, 500)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    exact = {r.point: r for r in kernel_density(df, "x", 11, 0.4, bins=None).collect()}
    binned = {r.point: r for r in kernel_density(df, "x", 11, 0.4, bins=500).collect()}
    for point, row in exact.items():
        direct = np.mean(np.exp(-0.5 * ((values - row.grid_x) / 0.4) ** 2)) / (0.4 * math.sqrt(2 * math.pi))
        assert row.density == pytest.approx(direct)
        assert binned[point].density == pytest.approx(direct, abs=2e-3)


def test_numbering_is_gapless_and_ordered(spark):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).alias("key"))
    rows = number_rows(df, ["key"], "n", start=10).collect()
    assert all(r.n == r.key + 10 for r in rows) and len(rows) == 5000


def test_product_without_a_join(spark):
    df = cross_product(spark, SALES_DIMENSIONS)
    assert df.count() == df.distinct().count() == 23_040
    assert "Join" not in plan_of(df) and "Cartesian" not in plan_of(df) and "Exchange" not in plan_of(df)


def test_index_encode_decode(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "c"), (5, None)], "id int, s string")
    assert {r.id: r.s_index for r in index_strings(df).collect()} == {1: 0.0, 2: 1.0, 3: 0.0, 4: 2.0, 5: None}
    lines = df.select(encode_row(["id", "s"]).alias("line"))
    assert [r.line for r in lines.orderBy("line").collect()] == ["1,b", "2,a", "3,b", "4,c", "5,?"]
    back = lines.select(*decode_array(F.split("line", ","), {"id": "int", "s": "string"}))
    assert sorted(back.collect(), key=lambda r: r.id) == df.orderBy("id").collect()
    odd = ["a,b", "?", None, "", "\\", "\\c", "a\\,b", "x\0y", "\\0", "\\\\?"]
    pairs = spark.createDataFrame([(i, v) for i, v in enumerate(odd)], "id int, s string")
    text = pairs.select(encode_row(["id", "s", "id"]).alias("line"))
    kinds = {"id": "int", "s": "string", "again": "int"}
    got = text.select(*decode_array(F.split("line", ","), kinds)).orderBy("id").collect()
    assert [(r.id, r.s, r.again) for r in got] == [(i, v, i) for i, v in enumerate(odd)]


def test_splits_and_samples(spark):
    df = spark.range(20_000)
    rest, part = split_by_key(df, F.col("id"), 0.2)
    assert rest.count() + part.count() == 20_000
    assert abs(part.count() - 4_000) < 400
    assert part.intersect(rest).isEmpty()
    masked = mask_column(df.withColumn("v", F.lit(1)), "v", key_below(F.col("id"), 0.2))
    assert masked.where("v IS NULL").count() == part.count() and masked.count() == 20_000
    sample = key_sample(df, F.col("id"), 0.05, "s")
    assert abs(sample.count() - 1_000) < 200
    assert sorted(sample.collect()) == sorted(key_sample(df.repartition(7), F.col("id"), 0.05, "s").collect())
    drawn = key_sample_with_replacement(df, F.col("id"), 0.5)
    assert abs(drawn.count() - 10_000) < 600
    copies = {r["copy"]: r["count"] for r in drawn.groupBy("copy").count().collect()}
    assert copies[1] > copies[2] > copies[3]


def test_stream_restart_adds_nothing(spark):
    source, out, offsets = (new_folder(spark, n) for n in ("in", "out", "offsets"))
    schema = T.StructType([T.StructField("id", T.LongType())])
    spark.range(50).write.parquet(source)

    def run():
        messages = random_sales_messages(file_stream(spark, source, schema), "id")
        query = start_messages(messages, offsets, "parquet", {"path": out}, every=None)
        query.awaitTermination()
        return query

    lines = progress_lines(run())
    assert any(line.startswith("50 rows at ") for line in lines)
    run()
    got = spark.read.parquet(out)
    assert got.count() == 50
    body = got.select(F.from_json("value", MESSAGE_SCHEMA).alias("b"), "value", "key").collect()
    assert all(r.b.color in SALES_DIMENSIONS["color"] and "factor" not in r.value for r in body)
    assert sorted(int(r.key) for r in body) == list(range(50))
    spark.range(50, 60).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(out).count() == 60


def test_stream_reads_a_file_and_a_folder_of_parts(spark):
    folder = new_folder(spark, "layouts")
    spark.range(30).repartition(3).write.parquet(f"{folder}/parts/events.parquet")
    spark.range(30).coalesce(1).write.parquet(f"{folder}/one")
    os.makedirs(f"{folder}/single".removeprefix("file:"))
    part = next(n for n in os.listdir(f"{folder}/one") if n.startswith("part-"))
    os.link(f"{folder}/one/{part}", f"{folder}/single/events.parquet")
    schema = T.StructType([T.StructField("id", T.LongType())])
    for kind in ("parts", "single"):
        rows = file_stream(spark, f"{folder}/{kind}", schema, "events.parquet").select(
            F.col("id").cast("string").alias("key"), F.lit("").alias("value")
        )
        out = new_folder(spark, "read")
        start_messages(rows, new_folder(spark, "offsets"), "parquet", {"path": out}, every=None).awaitTermination()
        assert spark.read.parquet(out).count() == 30


def test_rate_stream_and_kafka_options(spark):
    assert sales_stream(spark).isStreaming
    assert sales_stream(spark).columns == ["key", "value"]
    options = kafka_options("host:9093", "topic", "login")
    assert options["kafka.sasl.mechanism"] == "PLAIN" and options["topic"] == "topic"
    path = new_folder(spark, "batch")
    write_messages(random_sales_messages(spark.range(5), "id", seed=1), "parquet", {"path": path})
    assert spark.read.parquet(path).count() == 5


def test_scans_prune_and_push_down(spark):
    from weftline.plans import all_jobs

    jobs = all_jobs()
    band = plan_of(jobs["year_band_pivot"][0](spark, TABLES))
    assert "GreaterThanOrEqual(o_orderdate" in band and "o_totalprice" not in band
    scan = plan_of(jobs["scan_parquet"][0](spark, TABLES))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in scan
    part = plan_of(jobs["scan_partitioned"][0](spark, TABLES))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in part
    for name in ("chop_swap_native", "chop_swap_sqlexpr", "chop_swap_sqlfn"):
        assert "EvalPython" not in plan_of(jobs[name][0](spark, TABLES))
    for name in ("grouped_pandas", "string_index"):
        joined = plan_of(jobs[name][0](spark, TABLES))
        assert "BroadcastHashJoin" in joined and "Exchange hashpartitioning" not in joined
    assert plan_of(jobs["profile_numeric"][0](spark, TABLES)).count("Scan parquet") == 1
