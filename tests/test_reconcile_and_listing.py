"""Reconciliation by content, level-by-level listing, draws with large means, the shared folder."""

import math
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from weftline.operators.reconcile import differing_keys
from weftline.operators.sampling import key_sample_with_replacement
from weftline.sources.files import list_files
from weftline.workspace import shared_root

SCHEMA = "id bigint, name string, value double, tags array<string>"


def compared(spark, left, right, **options):
    sides = [spark.createDataFrame(rows, SCHEMA) for rows in (left, right)]
    found = differing_keys(*sides, ["id"], **options).collect()
    assert all(r.differing_columns is None or r.left_rows == r.right_rows for r in found)
    return {r.id: (r.left_rows, r.right_rows, r.differing_columns) for r in found}


ROWS = [(n, f"n{n % 7}", n / 3, ["a", None]) for n in range(500)] + [(None, None, None, None)] * 2


@pytest.mark.parametrize("slices", [1, 64, 65_536])
def test_one_changed_value_is_named(spark, slices):
    changed = [(n, name, -1.0 if n == 321 else value, tags) for n, name, value, tags in ROWS]
    assert compared(spark, ROWS, changed, slices=slices) == {321: (1, 1, ["value"])}


def test_order_and_equal_tables(spark):
    assert compared(spark, ROWS, ROWS[::-1]) == {}
    assert compared(spark, [], []) == {}
    assert compared(spark, [(1, "a", 0.0, None)], [(1, "a", -0.0, None)]) == {}


def test_missing_repeated_and_null_rows(spark):
    right = ROWS[1:] + [ROWS[9], (None, None, None, None), (900, "x", 1.0, [])]
    assert compared(spark, ROWS, right) == {0: (1, 0, None), 9: (1, 2, None), None: (2, 3, None), 900: (0, 1, None)}
    assert compared(spark, [], ROWS[:2]) == {0: (0, 1, None), 1: (0, 1, None)}


def test_place_of_nulls_and_combination_of_values(spark):
    assert compared(spark, [(1, None, None, ["a", None])], [(1, None, None, [None, "a"])]) == {1: (1, 1, ["tags"])}
    left, right = [(1, "a", 1.0, None), (1, "b", 2.0, None)], [(1, "a", 2.0, None), (1, "b", 1.0, None)]
    assert compared(spark, left, right) == {1: (2, 2, [])}


def test_columns_must_agree(spark):
    left = spark.createDataFrame([(1, "a")], "id bigint, `a.b` string")
    assert differing_keys(left, left.select("`a.b`", "id"), ["id"]).count() == 0
    assert differing_keys(left, left, ["id", "a.b"]).count() == 0
    for right, key in [(left.drop("a.b"), ["id"]), (left.withColumn("id", F.col("id").cast("int")), ["id"]), (left, ["x"]), (left, [])]:
        with pytest.raises(ValueError):
            differing_keys(left, right, key)
    with pytest.raises(ValueError):
        differing_keys(left.withColumn("left_rows", F.lit(1)), left.withColumn("left_rows", F.lit(1)), ["id"])


def test_listing_of_a_skewed_tree(spark, tmp_path):
    root, wanted = tmp_path / "root", set()
    for n in range(120):
        folder = root / "deep" / f"a{n % 5}" / f"b {n}"
        folder.mkdir(parents=True)
        (folder / f"{n}.txt").write_text("x" * n)
        wanted.add((str(folder / f"{n}.txt"), n))
    for hidden in ("deep/_temporary", "deep/a1/.staging", "_log"):
        (root / hidden / "sub").mkdir(parents=True)
        (root / hidden / "sub" / "no.txt").write_text("no")
    (root / "top.txt").write_text("top")
    (root / "empty").mkdir()
    wanted.add((str(root / "top.txt"), 3))
    listed = list_files(spark, str(root)).collect()
    assert len(listed) == len(wanted)
    assert {(r.path.removeprefix("file:"), r.length) for r in listed} == wanted
    assert all(r.name == os.path.basename(r.path) and r.category == r.path.split("/")[-2] for r in listed)
    assert list_files(spark, str(root / "empty")).count() == 0


@pytest.mark.parametrize("mean", [0, 0.5, 20])
def test_draws_follow_their_law(spark, mean):
    rows = 4_000
    drawn = key_sample_with_replacement(spark.range(rows), F.col("id"), mean)
    copies = [r["count"] for r in drawn.groupBy("id").count().collect()]
    copies += [0] * (rows - len(copies))
    average = sum(copies) / rows
    spread = sum((c - average) ** 2 for c in copies) / rows
    assert abs(average - mean) <= 5 * math.sqrt(mean / rows)
    assert abs(spread - mean) <= 0.15 * mean
    with pytest.raises(ValueError):
        key_sample_with_replacement(spark.range(1), F.col("id"), 1_000)


def test_several_machines_need_a_shared_folder():
    def session(master, **settings):
        conf = SimpleNamespace(get=lambda name, default=None: settings.get(name.replace(".", "_"), default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    own, shared = "file:/home/me/spark-warehouse", "hdfs://store/warehouse/"
    assert shared_root(session("local[4]", spark_sql_warehouse_dir=own)) == own
    assert shared_root(session("yarn", spark_sql_warehouse_dir=shared)) == "hdfs://store/warehouse"
    assert shared_root(session("yarn", spark_sql_warehouse_dir=own, spark_checkpoint_dir="/mnt/all/")) == "/mnt/all"
    with pytest.raises(RuntimeError):
        shared_root(session("yarn", spark_sql_warehouse_dir=own))
