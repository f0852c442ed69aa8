"""Time the headline jobs: ``BENCH_SF_DIR``, ``BENCH_CPUS``; names as arguments pick jobs.

Prints one JSON line. Each job runs once to warm up, then up to three times; the median
counts. Jobs are drained into a sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import random
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import chop_swap
from weftline.plans import all_jobs
from weftline.sinks.files import move_files, write_file_per_row
from weftline.workspace import cached, new_folder

HEADLINE = [
    "summary_matrix", "summary_rollup", "year_band_pivot", "cross_product", "missing_months",
    "scan_csv_multiline", "sink_csv_single", "sink_csv_indexed", "compact_cluster",
    "table_conform", "table_conform_csv", "reconcile_counts", "parse_datetimes",
    "scan_mixed_delimiter", "grouped_pandas", "profile_numeric", "histogram_density", "kernel_density",
    "kernel_density_binned", "string_index", "knn_impute_global", "knn_impute_manhattan", "knn_impute_hvdm",
    "impute_compare", "keyed_json_batch", "stream_keyed_json", "files_write",
]
# The string function is timed on the identifiers repeated to this many rows.
SWAP_ROWS = 4_000_000
PATIENCE = 10.0


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def median(work) -> float:
    first = timed(work)
    repeats = 3 if first < PATIENCE / 3 else 1
    return statistics.median(timed(work) for _ in range(repeats))


def swap_runs(spark: SparkSession, folder: str, rounds: int = 3) -> list[dict]:
    """Runs of all flavours over one cached column, in shuffled order: ``{method, round, seconds}``."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    copies = max(1, SWAP_ROWS // max(1, events.count()))
    text = F.concat(F.md5(F.col("event_id").cast("string")), F.md5("event_type"))
    rows = events.select(text.alias("uuid")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    name = chop_swap.register_sql_function(spark)
    flavours = {k: f(F.col("uuid")) for k, f in chop_swap.FLAVOURS.items()}
    flavours["sql_expression"] = chop_swap.sql_expression("uuid")
    flavours["sql_function"] = F.expr(f"{name}(uuid)")
    runs = []
    with cached(rows.select("uuid").repartition(spark.sparkContext.defaultParallelism)) as column:
        drain(column)
        for column_of in flavours.values():
            drain(column.select(column_of.alias("swapped")).limit(10_000))
        order = [(method, n) for n in range(rounds) for method in flavours]
        random.Random(1).shuffle(order)
        for method, n in order:
            seconds = timed(lambda m=method: drain(column.select(flavours[m].alias("swapped"))))
            runs.append({"method": method, "round": n, "seconds": round(seconds, 3)})
    return runs


def means(runs: list[dict]) -> dict[str, float]:
    by_method: dict[str, list[float]] = {}
    for run in runs:
        by_method.setdefault(f"swap_{run['method']}", []).append(run["seconds"])
    return {method: statistics.mean(times) for method, times in by_method.items()}


def move_times(spark: SparkSession, folder: str) -> dict[str, float]:
    """Moving one file per document: one task against all."""
    root = new_folder(spark, "bench-files")
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    named = documents.select(
        F.concat(F.lit(f"{root}/a/"), F.col("doc_id").cast("string")).alias("path"),
        "text",
    )
    written = write_file_per_row(named, "path", "text").select("path")
    there = written.withColumn("destination", F.regexp_replace("path", "/a/", "/b/"))
    back = there.select(F.col("destination").alias("path"), F.col("path").alias("destination"))
    return {
        "move_one_task": timed(lambda: move_files(there, 1)),
        "move_all_tasks": timed(lambda: move_files(back)),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("weftline-bench")
        .config("spark.ui.enabled", False).config("spark.ui.showConsoleProgress", False)
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    jobs = all_jobs()
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        times[name] = median(lambda: drain(jobs[name][0](spark, folder)))
        print(f"{name}: {times[name]:.2f}s", file=sys.stderr, flush=True)
    if not sys.argv[1:]:
        runs = swap_runs(spark, folder)
        times |= means(runs)
        times |= move_times(spark, folder)
    rounded = {k: round(v, 3) for k, v in times.items()}
    line = {
        "metric": "headline_jobs_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": rounded, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if "swap_native" in times:
        line["swap_relative_to_native"] = {
            k: round(v / times["swap_native"], 2) for k, v in times.items() if k.startswith("swap_")
        }
        line["swap_runs"] = runs
        line["move_speed_up"] = round(times["move_one_task"] / times["move_all_tasks"], 2)
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
