"""Compare jobs with their oracle SQL: ``python tests/check.py [folder] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(str(plain(v)) for v in value) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(spark, con, folder, job, sql):
    """None when equal, else a short text; plus the number of rows."""
    frame = job(spark, folder)
    mine = frame.collect()
    if sql is None:
        return (None if mine else "no rows"), len(mine)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", len(mine)
    a, b = rows_of(frame.columns, mine), rows_of(names, theirs)
    if a == b:
        return None, len(mine)
    only_a = sorted(set(a) - set(b))[:3]
    only_b = sorted(set(b) - set(a))[:3]
    return f"{len(a)} vs {len(b)} rows; only job: {only_a}; only oracle: {only_b}", len(mine)


def main():
    from pyspark.sql import SparkSession

    from weftline.plans import all_jobs

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", False).config("spark.ui.showConsoleProgress", False)
        .config("spark.sql.shuffle.partitions", 8).config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    failed = 0
    for name, (job, sql) in all_jobs().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            problem, count = difference(spark, con, folder, job, sql)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, count = f"{type(error).__name__}: {str(error)[:300]}", 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:24s} {count:8d} rows {time.time() - start:6.2f}s "
              f"{'' if sql else '(no oracle)'} {problem or ''}", flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()
