"""Delimited text, string functions, file sinks and file moves."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pandas as pd
from pyspark.sql import functions as F

from weftline.functions import chop_swap
from weftline.functions.grouped import center_by_group
from weftline.functions.strings import pad_number, random_text
from weftline.sinks.csv import write_indexed, write_named_parts, write_parts
from weftline.plans import files as plan_files
from weftline.sinks import files as sink_files
from weftline.sinks.files import move_files, write_file_per_row
from weftline.sources import files
from weftline.sinks.header import write_header
from weftline.sources.files import list_files, missing_months
from weftline.sources.text import read_csv, read_mixed_delimiter, strip_wrappers, without_markers

# Sample file and identifier pair with known results.
SAMPLE = """Name|Color|Size|Origin
Rabbit^|^Brown^|7|^Warehouse
Horse^|^Green^|28|^Dock
Pig^|^Orange^|17|^Port
Cow^|^Blue^|23|^Warehouse
Bird^|^Yellow^|2|^Dock
Dog^|^Brown^|10|^Port
Carrot^Man^|^Orange^|22|^Warehouse
"""
LONG = "63dc895fe59caecedeae490969eee8a061fa1e02e5ea354fe6d1e353b7b8ece4"
SWAPPED = "e6d1e353b7b8ece4-63dc895fe59caecedeae490969eee8a061fa1e02e5ea354f"


@pytest.fixture
def sample(tmp_path):
    path = tmp_path / "data.txt"
    path.write_text(SAMPLE)
    return str(path)


def test_both_ways_to_read_wrapped_fields(spark, sample):
    first, last = ("Rabbit", "Brown", "7", "Warehouse"), ("Carrot^Man", "Orange", "22", "Warehouse")
    for df in (read_mixed_delimiter(spark, sample).drop("_surplus"), strip_wrappers(read_csv(spark, sample, sep="|"))):
        rows = [tuple(r) for r in df.collect()]
        assert df.columns == ["Name", "Color", "Size", "Origin"]
        assert len(rows) == 7 and first in rows and last in rows


def test_repeated_header_and_outer_carets(spark, tmp_path):
    path = tmp_path / "more.txt"
    path.write_text("A|^B\n^x|^y^\nA|^B\n^^z^^|w\nshort\n1|2|3\n")
    df = read_mixed_delimiter(spark, str(path))
    assert sorted((tuple(r) for r in df.collect()), key=str) == [
        ("1", "2", ["3"]), ("^^z^", "w", None), ("^x", "y^", None), ("short", None, None)]
    one = spark.createDataFrame([("^^a^^",)], "`^v^` string")
    assert strip_wrappers(one).first().asDict() == {"v": "^a^"}


def test_each_file_has_its_own_header(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "one.txt").write_text("A|B\n1|2\n")
    (folder / "two.txt").write_text("B|A|C\n3|4|5\n")
    rows = read_mixed_delimiter(spark, str(folder)).select("A", "B", "C").collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "2", None), ("4", "3", "5")]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab^|", max_size=12), min_size=1, max_size=20))
def test_marker_removal_equals_plain_replacement(spark, lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    got = {r.i: r.out for r in df.select("i", without_markers(F.col("line")).alias("out")).collect()}
    assert got == {i: line.replace("|^", "|").replace("^|", "|") for i, line in enumerate(lines)}


def test_all_flavours_agree(spark):
    values = [LONG, "short", "", None, "é" * 70]
    df = spark.createDataFrame([(v,) for v in values], "text string")
    name = chop_swap.register_sql_function(spark)
    python_name = chop_swap.register_python_udf(spark)
    columns = {k: f(F.col("text")).alias(k) for k, f in chop_swap.FLAVOURS.items()}
    rows = df.select(
        *columns.values(), chop_swap.sql_expression("text").alias("sql"),
        F.expr(f"{name}(text)").alias("fn"), F.expr(f"{python_name}(text)").alias("registered"),
    ).collect()
    assert rows[0]["native"] == SWAPPED
    for row in rows:
        assert len(set(row)) == 1
    plan = df.select(F.expr(f"{name}(text)"))._jdf.queryExecution().executedPlan().toString()
    assert "Eval" not in plan


def test_padding_and_random_text(spark):
    ids = spark.createDataFrame([(7,), (123456789,)], "id bigint")
    assert [r[0] for r in ids.select(pad_number(F.col("id"))).collect()] == ["00000007", "123456789"]
    made = [r[0] for r in spark.range(200).select(random_text(F.lit(30), 3)).collect()]
    assert len(set(made)) == 200 and all(len(m) == 30 and m.isalnum() for m in made)
    assert spark.range(1).select(random_text(F.lit(0), 3)).first()[0] == ""


def _lines(folder):
    names = sorted(n for n in os.listdir(folder) if n.endswith(".csv") and not n.startswith("."))
    return names, [open(os.path.join(folder, n)).read().split() for n in names]


def test_named_parts_are_ordered(spark, tmp_path):
    df = spark.range(1000).repartition(4)
    written = write_named_parts(df, str(tmp_path / "out" / "numbers"), ["id"], header=True)
    names, parts = _lines(tmp_path / "out" / "numbers")
    assert names == [f"numbers-{i:05d}.csv" for i in range(written)]
    assert all(lines[0] == "id" for lines in parts)
    assert [x for lines in parts for x in lines[1:]] == list(map(str, range(1000)))
    write_parts(df, str(tmp_path / "parts"))
    assert sum(n.endswith(".csv") for n in os.listdir(tmp_path / "parts")) == 4


def test_indexed_parts(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "name string, n int")
    write_indexed(df, str(tmp_path / "i"), ["name"])
    _, parts = _lines(tmp_path / "i")
    assert {lines[0] for lines in parts} == {"_c0,name,n"}
    assert [x for lines in parts for x in lines[1:]] == ["0,a,1", "1,b,2", "2,c,3"]


def test_header_file(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, "x"), (4, -1.0, "y")], "a int, b double, c string")
    write_header(df, "things", "b", str(tmp_path / "head"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "head")).collect()]
    assert lines == ["@relation things", "@attribute a integer [1, 4]", "@attribute b real [-1.0, 2.5]",
                     "@attribute c Invalid Type", "@inputs a, c", "@outputs b", "@data"]


def test_files_are_written_moved_and_counted(spark, tmp_path):
    rows = [(f"{tmp_path}/a/{i}.txt", f"text {i}") for i in range(20)]
    written = write_file_per_row(spark.createDataFrame(rows, "path string, content string"), "path", "content")
    assert written.where("ok").count() == 20
    moves = spark.createDataFrame(
        [(p, p.replace("/a/", "/b/")) for p, _ in rows] + [(f"{tmp_path}/a/none.txt", f"{tmp_path}/b/none.txt")],
        "path string, destination string",
    )
    first = {r.move_result: r.n for r in move_files(moves).groupBy("move_result").agg(F.count("*").alias("n")).collect()}
    assert first == {True: 20, False: 1}
    # A repeated task finds its work done.
    assert move_files(moves).where("move_result").count() == 20
    assert list_files(spark, f"{tmp_path}/b").count() == 20
    assert open(f"{tmp_path}/b/3.txt").read() == "text 3"
    assert not os.listdir(tmp_path / "a")


def test_nothing_is_overwritten(spark, tmp_path):
    rows = [(f"{tmp_path}/x.txt", "old"), (f"{tmp_path}/null.txt", None)]
    frame = spark.createDataFrame(rows, "path string, content string")
    for _ in range(2):  # the same content again counts as written, NULL never
        got = {r.path[-8:]: r.ok for r in write_file_per_row(frame, "path", "content").collect()}
        assert sorted(got.values()) == [False, True]
    other = spark.createDataFrame([(f"{tmp_path}/x.txt", "new")], "path string, content string")
    assert write_file_per_row(other, "path", "content").where("ok").count() == 0
    (tmp_path / "y.txt").write_text("y")
    move = spark.createDataFrame([(f"{tmp_path}/y.txt", f"{tmp_path}/x.txt")], "path string, destination string")
    assert move_files(move).where("move_result").count() == 0
    assert (tmp_path / "x.txt").read_text() == "old" and (tmp_path / "y.txt").exists()
    assert not (tmp_path / "null.txt").exists()


def test_missing_months(spark):
    spans = spark.createDataFrame([("y", "2020-11", "2021-02"), ("g", "2020-01", "2020-01")],
                                  "kind string, first_month string, last_month string")
    have = spark.createDataFrame([("y", "2020-12"), ("g", "2020-01")], "kind string, month string")
    assert sorted(tuple(r) for r in missing_months(spans, have, "kind").collect()) == [
        ("y", "2020-11"), ("y", "2021-01"), ("y", "2021-02")]


def test_pandas_per_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 2.0), ("b", None)], "k string, v double")
    rows = sorted(str(tuple(r)) for r in center_by_group(df, "k", "v", "c").collect())
    assert rows == sorted(map(str, [("a", 1.0, -1.0), ("a", 3.0, 1.0), ("b", 5.0, 0.0), (None, 2.0, 0.0), ("b", None, None)]))


def test_a_wide_folder_is_listed_in_bounded_frames(tmp_path, monkeypatch):
    """a task holds some entries of a folder at a time, not all of them."""
    monkeypatch.setattr(files, "ENTRIES_AT_ONCE", 10)
    for i in range(35):
        (tmp_path / f"{i}.txt").write_text("x" * i)
    (tmp_path / "below").mkdir()
    (tmp_path / "_hidden").write_text("")
    frames = list(files._list_level(iter([pd.DataFrame({"folder": [str(tmp_path)]})])))
    assert max(map(len, frames)) <= 10
    rows = pd.concat(frames)
    assert dict(zip(rows["path"], rows["length"])) == {f"{tmp_path}/{i}.txt": i for i in range(35)} | {f"{tmp_path}/below": -1}


def test_file_times_are_those_of_arrow(tmp_path):
    from pyarrow.fs import LocalFileSystem

    (tmp_path / "a.txt").write_text("a")
    (frame,) = files._list_level(iter([pd.DataFrame({"folder": [str(tmp_path)]})]))
    assert frame["modificationTime"][0] == LocalFileSystem().get_file_info(f"{tmp_path}/a.txt").mtime


def test_file_work_is_dealt_out_wherever_rows_lie(spark):
    """eight parts of which seven are empty are not left as they are."""
    rows = spark.range(200).select(F.concat(F.lit("/a/"), F.col("id").cast("string")).alias("path")).coalesce(1)
    lying = rows.union(spark.range(0, 0, 1, 7).select(F.lit("x").alias("path")))
    assert lying.rdd.getNumPartitions() >= 8
    parts = sink_files._spread(lying, None, "path").select(F.spark_partition_id().alias("part")).distinct().count()
    assert parts >= 6


def test_folders_of_documents_are_bounded(spark, monkeypatch):
    """no folder holds all files of a language."""
    monkeypatch.setattr(plan_files, "FILES_PER_FOLDER", 20)
    root, written = plan_files._document_files(spark, "/root/testdata/sf0.001")
    listed = list_files(spark, root)
    assert listed.count() == written.where("ok").count() == written.count()
    assert listed.groupBy(F.regexp_extract("path", "^(.*)/", 1).alias("folder")).count().agg(F.max("count")).first()[0] <= 40


def test_mixed_sizes_are_written_by_all_parts(spark, tmp_path):
    """the large files are not the work of two tasks."""
    items = spark.range(600, numPartitions=6).select(
        F.col("id").alias("l_orderkey"), F.lit("A").alias("l_returnflag"),
        F.lit("1998-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    plan_files._write_mixed_sizes(items, str(tmp_path / "items"))
    assert len([n for n in os.listdir(tmp_path / "items" / "l_returnflag=A") if n.endswith(".parquet")]) == 6
    assert spark.read.parquet(str(tmp_path / "items")).count() == 600
