"""Clustering, compaction, incremental loads, stream sources and sinks, learned indexes, density curves."""

import math
import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.operators.conform import Contract
from weftline.operators.features import LabelIndex
from weftline.operators.profile import density_curves
from weftline.sinks.clustering import compact_curve, curve_key, interleaved, quantile_rank
from weftline.sinks.manifest import compact_small, current_files, read_current, versions
from weftline.sources.incremental import batch_numbers, changed_files, ledger, load_new, loaded_rows, rows_aside
from weftline.streaming.commits import read_committed, start_committed, write_epoch
from weftline.streaming.irregular import BatchPlan, irregular_rows
from weftline.streaming.messages import file_stream, start_messages
from weftline.workspace import Storage, new_folder


def local(path):
    return path.removeprefix("file:")


def parquet_files(folder):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(local(folder)) for f in files if f.endswith(".parquet"))


def test_curve_files_are_small_boxes(spark):
    rng = random.Random(1)
    rows = [(i % 2, rng.random(), math.exp(5 * rng.random()), f"n{i:06d}") for i in range(20_000)]
    source, target = new_folder(spark, "s"), new_folder(spark, "t")
    frame = spark.createDataFrame(rows, "p int, x double, y double, name string")
    frame.write.partitionBy("p").parquet(source)
    size = sum(map(os.path.getsize, parquet_files(source)))
    out = compact_curve(spark, source, target, ["p"], ["x", "y"], file_bytes=size // 32)
    assert sorted(map(tuple, out.select("p", "x", "y", "name").collect())) == sorted(rows)
    files = parquet_files(target)
    assert len(files) >= 30
    for column, low in (("x", 0.9), ("y", math.exp(4.5))):  # a tenth of the rows, by either column
        hit = 0
        for path in files:
            meta = pq.ParquetFile(path).metadata
            at = meta.schema.names.index(column)
            hit += any(meta.row_group(g).column(at).statistics.max >= low for g in range(meta.num_row_groups))
        assert hit <= len(files) / 2, (column, hit, len(files))


def test_ranks_and_key(spark):
    bounds = [float(b) for b in [1, 2, 2, 5, 7, 8, 9]]
    values = [None, -1.0, 1.0, 2.0, 4.9, 5.0, 8.5, 9.0, 100.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in frame.select(quantile_rank(F.col("v"), bounds, 3)).collect()]
    assert got == [0 if v is None else sum(b <= v for b in bounds) for v in values]
    key = spark.range(1).select(interleaved([F.lit(0b101), F.lit(0b011)], 3)).first()[0]
    assert key == 0b100111
    mixed = spark.createDataFrame([("a", 1), (None, None), ("zz", 3)], "s string, n int")
    assert mixed.select(curve_key(mixed, ["s", "n"])).where("1 = 1").count() == 3
    with pytest.raises(ValueError):
        curve_key(mixed, ["n"] * 9)


def test_only_small_files_are_rewritten(spark):
    location = new_folder(spark, "d")
    rng = random.Random(2)
    large = spark.createDataFrame([(i, rng.random(), "a") for i in range(30_000)], "i bigint, v double, p string")
    large.coalesce(1).write.partitionBy("p").parquet(location)
    limit = int(1.2 * max(map(os.path.getsize, parquet_files(location))))
    before = {f: os.path.getmtime(f) for f in parquet_files(location)}
    small = spark.createDataFrame([(i, rng.random(), "a+b" if i % 3 else "a") for i in range(30_000, 45_000)], large.schema)
    small.repartition(12).write.mode("append").partitionBy("p").parquet(location)
    every = sorted(map(tuple, spark.read.schema(large.schema).parquet(location).collect()))
    assert compact_small(spark, location, ["p"], large.schema, limit) == 24
    assert all(os.path.getmtime(f) == t for f, t in before.items())
    files = current_files(spark, location).collect()
    assert {local(r["path"]) for r in files} & set(before) == set(before)
    assert len(files) < 8 and all(r["length"] <= 1.1 * limit for r in files)
    assert sorted(map(tuple, read_current(spark, location, large.schema).select("i", "v", "p").collect())) == every
    assert versions(spark, location) == [1]
    assert compact_small(spark, location, ["p"], large.schema, 1000) == 0
    again = compact_small(spark, location, ["p"], large.schema, 100 * limit, large_share=1)
    assert again == 2 and sorted(map(tuple, read_current(spark, location, large.schema).select("i", "v", "p").collect())) == every
    with pytest.raises(Exception):
        Storage(spark).publish(new_folder(spark, "missing"), f"{location}/_manifests/00000001")


CONTRACT = Contract(
    schema=T.StructType([T.StructField("id", T.LongType(), False), T.StructField("amount", T.DoubleType()), T.StructField("taxi_type", T.StringType()), T.StructField("filename", T.StringType())]),
    synonyms={"amt": "amount"},
)


def test_growing_folders_load_once(spark):
    root, location = new_folder(spark, "raw"), new_folder(spark, "loaded")

    def add(folder, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/{folder}")

    def ids():
        return sorted(r.id for r in loaded_rows(spark, location, CONTRACT).collect())

    add("yellow", [(1, "1.5"), (2, "x")], "id bigint, amt string")
    first = load_new(spark, root, location, CONTRACT)
    assert (first["batch"], first["files"], first["source"], first["with_values_left_out"]) == (1, 1, 2, 1)
    assert load_new(spark, root, location, CONTRACT) is None
    add("yellow", [(3, 2.0)], "id bigint, amount double")
    add("green", [(None, 1.0), (4, 4.0)], "id bigint, amount double")

    def cut():
        raise InterruptedError

    with pytest.raises(InterruptedError):
        load_new(spark, root, location, CONTRACT, before_commit=cut)
    assert ids() == [1, 2] and batch_numbers(spark, location) == [1]
    second = load_new(spark, root, location, CONTRACT)
    assert (second["loaded"], second["rejected"], second["files"]) == (2, 1, 2) and ids() == [1, 2, 3, 4]
    add("green", [(5, 1.0)], "id bigint, amount double")
    load_new(spark, root, location, CONTRACT)
    whole = new_folder(spark, "whole")
    load_new(spark, root, whole, CONTRACT)
    order = ["id", "amount", "taxi_type", "filename"]
    assert sorted(map(tuple, loaded_rows(spark, location, CONTRACT).select(order).collect())) == sorted(map(tuple, loaded_rows(spark, whole, CONTRACT).select(order).collect()))
    aside = rows_aside(spark, location, CONTRACT).collect()
    assert sorted((r.id is None, r.batch, tuple(r["_left_out"].items())) for r in aside) == [(False, 1, (("amt", "x"),)), (True, 2, ())]
    assert ledger(spark, location).count() == 4 and changed_files(spark, root, location).count() == 0


def test_streams_read_nothing_beside_their_path(spark):
    folder = new_folder(spark, "tables")
    one = spark.createDataFrame([(1,)], "id bigint")
    one.coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(2,)], "id bigint").write.parquet(f"{folder}/events.parquet_old")
    single = parquet_files(f"{folder}/events.parquet")[0]
    for path, name in ((folder, "events.parquet"), (os.path.dirname(single), os.path.basename(single))):
        out = new_folder(spark, "out")
        start_messages(file_stream(spark, path, one.schema, name), new_folder(spark, "c"), "parquet", {"path": out}, every=None).awaitTermination()
        assert [r.id for r in spark.read.parquet(out).collect()] == [1]


def test_irregular_batches_go_on_after_a_restart(spark):
    options = {"seed": 5, "rows": 40, "rowsSpread": 15, "seconds": 0, "secondsSpread": 0}
    out, checkpoint = new_folder(spark, "out"), new_folder(spark, "c")
    for batches in (2, 5):
        query = start_messages(irregular_rows(spark, **options, batches=batches), checkpoint, "parquet", {"path": out}, every="0 seconds")
        query.processAllAvailable()
        query.stop()
    plan, offset, want = BatchPlan({k: str(v) for k, v in options.items()} | {"batches": "5"}), {"batch": 0, "first": 0, "due": 0.0}, []
    while (step := plan.after(offset)) is not None:
        (number, first, rows), offset = step
        want += [(number, first + i) for i in range(rows)]
    assert sorted(map(tuple, spark.read.parquet(out).select("batch", "id").collect())) == want
    assert len({plan.batch(n)[0] for n in range(50)}) > 15
    sizes = [BatchPlan({}).batch(n) for n in range(4000)]
    assert 70 < sum(s for s, _ in sizes) / 4000 < 80 and 9.5 < sum(p for _, p in sizes) / 4000 < 10.5


@pytest.mark.parametrize("once", ["key", None])
def test_epochs_appear_once(spark, once):
    source, path, checkpoint = new_folder(spark, "in"), new_folder(spark, "sink"), new_folder(spark, "c")
    schema = "key string, value string"
    for n in range(2):
        rows = [(f"k{n}{i % 3}", str(i % 3)) for i in range(6)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        start_committed(stream, path, checkpoint, once_per_key=once).awaitTermination()
        return sorted(map(tuple, read_committed(spark, path).select("key", "value").collect()))

    assert read_committed(spark, path).count() == 0
    want = sorted((f"k{n}{i}", str(i)) for n in range(2) for i in range(3) for _ in range(1 if once else 2))
    assert run() == want
    Storage(spark).remove(f"{checkpoint}/commits/1")  # as if the stream had died after the sink's commit
    assert run() == want and len(parquet_files(f"{path}/data")) >= 2
    write_epoch(spark.createDataFrame([("late", "x")], schema), local(path), 1)
    assert read_committed(spark, path).count() == len(want)


def test_learned_index_on_other_rows(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 3)], "s string, n int")
    index = LabelIndex.fit(frame)
    path = new_folder(spark, "index")
    index.save(path)
    other = spark.createDataFrame([("b", 1), ("c", 2), (None, 3)], "s string, n int")
    loaded = LabelIndex.load(spark, path)
    assert sorted(map(tuple, loaded.transform(other).collect())) == [(1, 0.0), (2, 2.0), (3, None)]
    assert sorted(map(tuple, loaded.transform(other, unseen="null", keep=True).select("n", "s", "s_index").collect())) == [(1, "b", 0.0), (2, "c", None), (3, None, None)]
    with pytest.raises(Exception, match="was not there"):
        loaded.transform(other, unseen="error").collect()
    with pytest.raises(ValueError):
        loaded.transform(other, unseen="drop")
    empty = LabelIndex.fit(frame.where("s IS NULL"))
    empty.save(f"{path}-empty")
    assert LabelIndex.load(spark, f"{path}-empty").transform(other).where("s_index = 0").count() == 2


def test_density_curves_keep_their_bound(spark):
    rng = random.Random(3)
    values = [rng.gauss(0, 1) if rng.random() < 0.7 else rng.gauss(6, 2) for _ in range(800)]
    rows = [(v, 5, None, math.nan if i % 100 == 0 else v * 1000) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "x double, same int, none double, wide double")
    got = {}
    for r in density_curves(frame, grid_points=81).collect():
        got.setdefault(r.column_name, []).append((r.point, r.grid_x, r.density))
    assert set(got) == {"x", "same", "wide"} and got["same"] == [(0, 5.0, None)]
    assert [p for p, _, _ in sorted(got["x"])] == list(range(81))
    n = len(values)
    mean = sum(values) / n
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1)) * n**-0.2
    step = (max(values) - min(values)) / 80
    bound = step**2 / (8 * h**3 * math.sqrt(2 * math.pi))
    for _, x, density in got["x"]:
        exact = sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in values) / (n * h * math.sqrt(2 * math.pi))
        assert abs(density - exact) <= bound + 1e-12
