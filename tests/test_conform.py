"""Schema conformance: names, collisions, bad values, loading, drift."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.contracts import TRIP_SYNONYMS, older_trips, trips
from weftline.operators.conform import Contract, conform, drift_report, sources_by_target
from weftline.sinks.table import compact, create_table, load_table, switch_location
from weftline.sources.files import read_conformed, schema_groups
from weftline.workspace import new_folder



def lineage():
    return {"filename": F.lit("f"), "taxi_type": F.lit("yellow")}


def test_target_schemas(spark):
    assert len(trips().schema) == 39
    assert len(older_trips().schema) == 29
    assert set(TRIP_SYNONYMS.values()) <= set(trips().schema.names)
    assert "surcharge" in older_trips().schema.names
    assert trips().required == ["taxi_type", "year", "filename"]


def test_bad_values_become_null_and_are_named(spark):
    raw = spark.createDataFrame(
        [("2020-01-02 03:04:05", "1.0", 1234567.0, 5.0, None), ("02/01/2020", "x", 1.005, None, 7.5)],
        "Trip_Pickup_DateTime string, ` Passenger_Count` string, Fare_Amt double, tip_amt double, Tips double",
    )
    rows = conform(raw, trips(), lineage()).collect()
    good, bad = rows
    assert good["pickup_datetime"] == dt.datetime(2020, 1, 2, 3, 4, 5)
    assert (good["year"], good["passenger_count"], float(good["tip_amount"])) == (2020, 1, 5.0)
    assert good["fare_amount"] is None and good["_invalid"] == "fare_amount"
    assert bad["year"] is None and float(bad["tip_amount"]) == 7.5
    assert sorted(bad["_invalid"].split(",")) == ["passenger_count", "pickup_datetime"]
    assert bad["_left_out"] == {"Trip_Pickup_DateTime": "02/01/2020", " Passenger_Count": "x"}


def test_whole_numbers_are_exact_and_conflicts_are_kept(spark):
    contract = Contract(T.StructType.fromDDL("n bigint, tip decimal(8,2)"), {"tips": "tip", "tip_amt": "tip"})
    raw = spark.createDataFrame(
        [("9007199254740993", 2.0, 1.0), ("1.9", None, 1.0), ("3.0", 1.0, 1.0), ("", None, None)], "n string, tip_amt double, tips double"
    )
    rows = conform(raw, contract).collect()
    assert [r.n for r in rows] == [9007199254740993, None, 3, None]
    assert [float(r.tip) if r.tip is not None else None for r in rows] == [1.0, 1.0, 1.0, None]
    assert rows[0]["_left_out"] == {"tip_amt": "2.0"} and rows[1]["_left_out"] == {"n": "1.9"} and rows[2]["_left_out"] == {}


def test_older_contract_ends_at_surcharge(spark):
    raw = spark.createDataFrame([("2012-05-06 00:00:00", "0.5")], "pickup_datetime string, improvement_surcharge string")
    row = conform(raw, older_trips(), lineage()).first()
    assert (row["year"], float(row["surcharge"])) == (2012, 0.5)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(sorted(TRIP_SYNONYMS)), unique=True, max_size=12), st.booleans())
def test_any_subset_of_names_conforms(spark, names, upper):
    columns = [n.upper() + " " if upper else n for n in names] + ["unknown_column"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    out = conform(spark.createDataFrame([], schema), trips(), lineage())
    assert out.columns == [*trips().schema.names, "_invalid", "_left_out"]
    assert [f.dataType for f in out.schema.fields[:-2]] == [f.dataType for f in trips().schema.fields]
    feeding = sources_by_target(columns, trips())
    assert set(feeding) - {"unknown_column"} == {TRIP_SYNONYMS[n] for n in names}


def test_files_of_different_schemas_load_into_one_table(spark):
    root, name = new_folder(spark, "raw"), "trips_test"
    spark.sql("SELECT '2019-01-01 10:00:00' AS Trip_Pickup_DateTime, 2.5D AS Fare_Amt").write.parquet(f"{root}/yellow")
    spark.sql("SELECT TIMESTAMP_NTZ '2020-01-01 10:00:00' AS lpep_pickup_datetime, 3 AS fare_amount "
              "UNION ALL SELECT NULL, 4").write.parquet(f"{root}/green")
    assert len(schema_groups(spark, root, "parquet")) == 2
    create_table(spark, name, trips(), new_folder(spark, "table"))
    aside = new_folder(spark, "aside")
    counts = load_table(read_conformed(spark, root, trips()), name, trips(), aside)
    kept = spark.read.parquet(aside).collect()
    assert [(r["_loaded"], float(r.fare_amount)) for r in kept] == [(False, 4.0)]
    assert (counts["source"], counts["loaded"], counts["rejected"]) == (3, 2, 1)
    rows = {(r.taxi_type, r.year): float(r.fare_amount) for r in spark.table(name).collect()}
    assert rows == {("yellow", 2019): 2.5, ("green", 2020): 3.0}
    location = new_folder(spark, "compacted")
    old = spark.table(name).select(F.first("filename")).first()[0]
    assert old.startswith("file:")
    table_path = spark.table(name).inputFiles()[0].rsplit("/taxi_type=", 1)[0]
    compact(spark, table_path, location, ["taxi_type", "year"], "pickup_datetime")
    switch_location(spark, name, location)
    assert spark.table(name).count() == 2
    pruned = spark.table(name).where("year BETWEEN 2019 AND 2019").inputFiles()
    assert len(pruned) == 1 and "year=2019" in pruned[0]
    spark.sql(f"DROP TABLE {name}")


def test_a_folder_of_mixed_schemas_is_read_whole(spark):
    root = new_folder(spark, "mixed")
    spark.sql("SELECT '2019-01-01 10:00:00' AS pickup_datetime, 1.5D AS fare_amt").write.parquet(f"{root}/yellow")
    spark.sql("SELECT '2019-01-02 10:00:00' AS pickup_datetime, '9' AS fare_amount").write.mode("append").parquet(f"{root}/yellow")
    assert len(schema_groups(spark, root, "parquet")) == 2
    rows = read_conformed(spark, root, trips()).collect()
    assert sorted(float(r.fare_amount) for r in rows) == [1.5, 9.0]


def test_csv_files_are_grouped_by_header(spark):
    root = new_folder(spark, "raw-csv")
    spark.sql("SELECT '2015-02-03 00:00:00' AS Pickup_date, 'B1' AS Dispatching_base_num").write.option("header", True).csv(f"{root}/fhv")
    spark.sql("SELECT '2014-02-03 00:00:00' AS lpep_pickup_datetime, '1' AS ` VendorID`").write.option("header", True).csv(f"{root}/green")
    rows = {r.taxi_type: r for r in read_conformed(spark, root, older_trips(), "csv").collect()}
    assert (rows["fhv"].year, rows["fhv"].dispatching_base_num) == (2015, "B1")
    assert (rows["green"].year, rows["green"].vendor_id) == (2014, "1")


def test_drift_report_names_every_column(spark):
    raw = spark.sql("SELECT 'a' AS VendorID, CAST(NULL AS STRING) AS other")
    report = {r.column_name: (r.target_name, r.action, r.value_count) for r in drift_report(raw, "f", trips()).collect()}
    assert report == {"VendorID": ("vendor_id", "renamed", 1), "other": (None, "skipped", 0)}


def test_rows_without_a_year_never_reach_the_table(spark):
    create_table(spark, "trips_none", trips(), new_folder(spark, "table"))
    raw = spark.sql("SELECT 'nonsense' AS pickup_datetime")
    counts = load_table(conform(raw, trips(), lineage()), "trips_none", trips(), new_folder(spark, "aside"))
    assert counts["rejected"] == 1 and counts["invalid_pickup_datetime"] == 1
    assert spark.table("trips_none").count() == 0
    spark.sql("DROP TABLE trips_none")
    with pytest.raises(ValueError):
        read_conformed(spark, _empty_folder(spark), trips())


def _empty_folder(spark):
    path = new_folder(spark, "empty")
    spark.range(0).write.csv(path + "/x")
    return path


def test_values_are_converted_once(spark):
    """F5, F7, F8, F9: what follows from a conversion refers to it and does not repeat it."""
    contract = Contract(schema=T.StructType.fromDDL("a decimal(8,2)"), synonyms={"b": "a"})
    df = spark.createDataFrame([(1.0, "2.5"), (None, "x"), (3.0, "3.00"), (None, None)], "a double, b string")
    out = conform(df, contract)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as decimal(8,2))") == 2
    got = [(r["a"] and float(r["a"]), r["_invalid"], r["_left_out"]) for r in out.collect()]
    assert got == [(1.0, "", {"b": "2.5"}), (None, "a", {"b": "x"}), (3.0, "", {}), (None, "", {})]


def test_loads_do_not_sort_by_partition(spark, tmp_path):
    """a task that writes partitions keeps them open instead of sorting all its rows."""
    from weftline.workspace import open_partitions

    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    with open_partitions(spark, 32):
        assert spark.conf.get(key) == "32"
        spark.range(100).withColumn("p", F.col("id") % 7).write.partitionBy("p").parquet(str(tmp_path / "out"))
    assert spark.conf.get(key, None) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
